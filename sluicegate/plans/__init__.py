"""Rule text to syntax tree, and what a tree tells before it runs."""
