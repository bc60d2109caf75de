"""voxloom: a Spark-native engine for building and auditing speech corpora."""

__version__ = "0.1.0"
