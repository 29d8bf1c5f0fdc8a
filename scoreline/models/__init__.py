"""Training, evaluating and simulating with ``pyspark.ml``."""
