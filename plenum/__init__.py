"""A Spark-native engine for consensus and validation over repeated, nested records."""
