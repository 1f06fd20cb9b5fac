"""Media analytics on Spark: the structured side of media understanding as DataFrame plans."""
