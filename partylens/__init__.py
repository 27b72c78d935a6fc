"""Customer analytics on Spark DataFrames: features, profiles, clusters, scoring."""
