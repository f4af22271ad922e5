"""Column expressions: calendar windows, measures and text helpers."""
