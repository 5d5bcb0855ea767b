"""A PySpark-native analytics engine for filings-style data and large text corpora."""
