"""Column expressions: cleaning rules, scalar helpers and tokenisers."""
