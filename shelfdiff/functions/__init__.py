"""Column functions. Everything here takes and returns Columns."""
