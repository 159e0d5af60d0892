"""DataFrame-in, DataFrame-out basket operators."""
