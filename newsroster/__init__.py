"""Media-mention analytics on Spark: landed search pages in, ranked mentions out."""

__version__ = "0.1.0"
