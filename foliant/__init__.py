"""foliant: an evidence engine for large document collections on PySpark."""

__version__ = "0.1.0"
