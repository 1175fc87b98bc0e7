"""Column-level building blocks (no shuffles, no actions)."""
