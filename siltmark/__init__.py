"""siltmark: a Spark-native engine that keeps a table of searchable document chunks in step with a tree of files."""
