"""Page-readability analytics as Spark DataFrame programs."""
