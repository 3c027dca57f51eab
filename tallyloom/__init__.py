"""Spark-native medallion analytics for messy financial transactions."""
