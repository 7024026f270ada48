"""Spark-first analytics over court-decision data."""
