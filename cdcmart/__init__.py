"""Change-data-capture mart on Spark: parse change events, upsert, keep history, report."""
