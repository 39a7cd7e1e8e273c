"""DataFrame operators for continuous and snapshot analytics on Spark."""
