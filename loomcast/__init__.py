"""loomcast: DataFrame-first analytics for media and text corpora on Apache Spark."""

__version__ = "0.1.0"
