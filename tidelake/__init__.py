"""tidelake: hourly developer-event archives as a three-layer lake on PySpark."""

__version__ = "0.1.0"
