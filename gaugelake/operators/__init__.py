"""DataFrame -> DataFrame transformations."""
