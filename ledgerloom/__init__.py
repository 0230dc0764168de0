"""Statement analytics on Spark: load, mine, report and check bank transactions."""
