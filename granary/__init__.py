"""Release, usage and catalog analytics expressed as PySpark DataFrame transformations."""

__version__ = "0.1.0"
