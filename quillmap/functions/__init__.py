"""Scalar functions, all native expressions."""
