"""Daily-market analytics as Spark DataFrame functions."""
