"""waveline: a PySpark-native engine for continuous multi-channel time series."""
