"""Column expressions: classifiers, labels, measures and formatting."""
