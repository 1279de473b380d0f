"""Ready marts built from the operators."""
