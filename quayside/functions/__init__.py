"""Column functions: names, checksums, text rewriting, paths and row rendering."""
