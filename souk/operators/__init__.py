"""DataFrame -> DataFrame operators on built-in Spark expressions and Spark ML."""
