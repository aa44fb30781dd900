"""Training-data operators; nothing outside this package imports it. registry.py has their queries and SQL."""
