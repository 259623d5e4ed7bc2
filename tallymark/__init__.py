"""Regional market analytics as ordinary Spark DataFrame plans."""
