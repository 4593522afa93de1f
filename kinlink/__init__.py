"""Record linkage and match search on Spark."""
