"""strata: layered session analytics on Spark (bronze -> silver -> gold)."""

__version__ = "0.1.0"
