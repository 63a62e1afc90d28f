"""Column functions: every scalar rule of the engine as a Spark expression."""
