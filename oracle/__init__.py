"""Independent SQL twins of the named results, for checking."""
