"""Citation corpus building on Spark: DataFrame-to-DataFrame operators and the jobs composed of them."""

__version__ = "0.1.0"
