"""Layer jobs composed from operators."""
