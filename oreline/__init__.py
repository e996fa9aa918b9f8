"""oreline: bronze, silver and gold tables on Spark, written as DataFrame plans."""
