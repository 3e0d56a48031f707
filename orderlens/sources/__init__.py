"""Reading, landing and writing tables."""
