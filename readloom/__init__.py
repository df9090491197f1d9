"""Spark-native long-read transcript analytics."""
