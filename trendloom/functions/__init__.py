"""Column expressions: text and id clean-up, sentiment weights, number formatting."""
