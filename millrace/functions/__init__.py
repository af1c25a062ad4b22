"""Column-level functions; every one is an expression that stays inside code generation."""
