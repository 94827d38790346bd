"""Spark-native medallion analytics for financial accounts."""
