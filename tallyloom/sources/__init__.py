"""Reading order lines and reviews, and writing and reading result tables."""
