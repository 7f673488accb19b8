"""Forest mapping on Spark: scenes as tables, every step DataFrame -> DataFrame."""
