"""Column expressions: text, numbers, time, places and code mappings."""
