"""Column functions: text, numbers, periods, labels."""
