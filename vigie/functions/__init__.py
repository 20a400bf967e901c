"""Column expressions shared by the operators (features, flags, ids, rounding)."""
