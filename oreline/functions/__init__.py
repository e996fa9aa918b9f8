"""Column-to-column functions, all native expressions."""
