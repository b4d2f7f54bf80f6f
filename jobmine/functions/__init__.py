"""Column expressions: text cleaning, pay parsing and vectors."""
