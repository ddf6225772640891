"""Spark-native preparation of image point annotations: ingest, classify, count, reconcile, write."""
