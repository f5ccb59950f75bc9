"""Change-data-capture lakehouse engine on PySpark."""
