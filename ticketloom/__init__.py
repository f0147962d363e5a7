"""Support-ticket and e-mail analytics as composable Spark DataFrame operators."""

__version__ = "0.1.0"
