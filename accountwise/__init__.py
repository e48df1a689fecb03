"""Customer-value analytics as Spark jobs: every operator is DataFrame in, DataFrame out."""
