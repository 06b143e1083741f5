"""Retail analytics over a star schema, written as Spark DataFrame and SQL jobs."""
