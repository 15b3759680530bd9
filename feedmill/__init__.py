"""Feed-to-report analytics on Spark: feed, bronze, silver, gold, models, marts, report."""
