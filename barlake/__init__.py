"""barlake: Spark-native analytics for time-ordered market candles."""

__version__ = "0.1.0"
