"""spark-submit jobs."""
