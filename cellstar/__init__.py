"""Spark-native engine for wide indicator sheets: cells to star schema to answers."""
