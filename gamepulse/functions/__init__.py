"""Column expressions: channel rules, time keys, strict casts."""
