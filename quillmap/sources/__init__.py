"""Sources and stores."""
