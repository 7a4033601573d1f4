"""Loomline: a Spark-native engine for checked batch localisation data."""
