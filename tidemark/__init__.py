"""Change-log analytics on Spark: CDC folding, aggregates, snapshots, maintenance."""
