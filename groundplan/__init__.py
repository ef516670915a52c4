"""groundplan: a PySpark-native engine for listing data and text corpora."""
