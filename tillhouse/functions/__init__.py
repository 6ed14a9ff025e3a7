"""Column functions: times, money, traffic, text, records, random values."""
