"""Column helpers; everything here stays inside whole-stage code generation (no Python per row)."""
