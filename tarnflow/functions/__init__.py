"""Column functions: text, sequences, statistics, taxonomy."""
