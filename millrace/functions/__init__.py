"""Column functions: text, globs and URLs."""
