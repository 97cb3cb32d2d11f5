"""Column expressions: cleaning, dates, ratios, money and JSON access."""
