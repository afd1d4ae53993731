"""Customer analytics on Spark: typed ingestion, versioned dimensions, marts, scores, actions and checks."""
