"""Column expressions: cleaning, labels, periods and product-name text."""
