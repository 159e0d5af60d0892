"""Reading and writing the basket tables."""
