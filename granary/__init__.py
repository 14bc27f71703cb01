"""Spark-native analytics operators: plain functions from DataFrame to DataFrame."""
