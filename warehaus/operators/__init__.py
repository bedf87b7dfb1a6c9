"""DataFrame -> DataFrame warehouse operators."""
