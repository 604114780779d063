"""Column functions: URL algebra, text, markup and token windows."""
