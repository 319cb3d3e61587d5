"""chronosift: a Spark-native engine for operational time-series signals."""
