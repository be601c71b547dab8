"""Reading, writing and managing tables."""
