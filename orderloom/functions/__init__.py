"""Column expressions: date parsing, text cleaning, exact money arithmetic."""
