"""Column functions: exact numerics, text cleaning, JSON documents, time."""
