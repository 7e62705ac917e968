"""Text-classification data work on Spark: DataFrame in, DataFrame out."""
