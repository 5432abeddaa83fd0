"""Review classification and run-metric analytics, written as PySpark DataFrame code."""

__version__ = "0.1.0"
