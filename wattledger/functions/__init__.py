"""Column expressions: time slots, text tests and channel lookups."""
