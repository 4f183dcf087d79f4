"""Layered data products on Spark: ingest, grade, summarise, audit and report.

Everything is a lazy DataFrame or Structured Streaming plan. The library runs
no Python on rows and keeps no data on the driver.
"""
