"""Reading and writing tables, and the source registry."""
