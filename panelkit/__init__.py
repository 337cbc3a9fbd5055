"""Panel analytics on Spark: labels, features, gains and models over customer snapshots."""
