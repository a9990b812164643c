"""Column -> Column functions; all native expressions, usable in batch and stream."""
