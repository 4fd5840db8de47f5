"""Column functions: text, hashes, vectors and pixels."""
