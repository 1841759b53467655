"""A Spark-native engine that searches, counts, samples and exports very large comment corpora."""
