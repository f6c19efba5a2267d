"""Relational operators built from DataFrame primitives (joins, aggregates, windows, generators)."""
