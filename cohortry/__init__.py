"""Batch and streaming analytics of a digital health-study platform, on PySpark."""
