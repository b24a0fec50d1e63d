"""Spark-native engine for keeping a catalog of linked pages and publishing it as feeds."""
