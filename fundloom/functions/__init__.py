"""Column expressions: coercions, dates, text extraction, statistics."""
