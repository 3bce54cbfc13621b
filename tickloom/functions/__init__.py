"""Column-level helpers: scalars and rolling windows."""
