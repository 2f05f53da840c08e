"""Batch analytics over operation, flow and cost records, written as Spark DataFrame plans."""
