"""Column helpers and distributed ordering primitives."""
