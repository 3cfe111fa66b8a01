"""Reading flat files and tables, and writing tables."""
