"""Column expressions: pure Column -> Column, no Python workers."""
