"""Column-level helpers: Java split rules and the routing hash."""
