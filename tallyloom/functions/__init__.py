"""Column expressions: text, messages, histogram statistics, JSON values."""
