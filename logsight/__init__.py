"""Query-log analytics on Spark: classify, aggregate, model, flag and report."""
