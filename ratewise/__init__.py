"""Review analytics as Spark DataFrame operators and pyspark.ml stages."""
