"""Column functions: cleaning, text, nested values, similarity, HTML."""
