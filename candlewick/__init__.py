"""Market-bar analytics expressed as PySpark DataFrame transformations."""
