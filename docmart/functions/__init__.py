"""Column functions: text normalisation and field extraction."""
