"""Column functions: names, categories, addresses."""
