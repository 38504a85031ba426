"""Column expressions: text, numbers, rewards, records."""
