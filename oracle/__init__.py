"""Plain SQL for the same results, run by another engine to check the Spark plans."""
