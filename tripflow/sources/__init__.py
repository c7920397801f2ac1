"""Reading, listing and writing tables."""
