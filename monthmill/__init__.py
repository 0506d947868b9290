"""Monthly customer snapshots in, labels, features and retail reports out, on Spark."""
