"""Customer-level analytics as plain Spark jobs: import, clean, join, label,
encode, train, score and evaluate, in batch and over streams."""
