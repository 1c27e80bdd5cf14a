"""Table-to-table building blocks."""
