"""A Spark-native snapshot-to-history engine for financial movements."""
