"""Column expressions: guarded casts, calendar arithmetic, small numeric helpers."""
