"""Column expressions: cleaning, typing, date parsing and path handling."""
