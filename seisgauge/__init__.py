"""Station data-quality analytics expressed as Spark DataFrame operators."""
