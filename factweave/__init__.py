"""A Spark-native provenance and entity-assembly engine."""
