"""Reading exports, and reading and writing stored tables."""
