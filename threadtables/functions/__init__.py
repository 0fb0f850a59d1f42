"""Column expressions: content access, text, profile fields."""
