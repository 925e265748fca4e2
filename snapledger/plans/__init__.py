"""Report tables assembled from the operators."""
