"""Warehouse reports, row changes and script lineage as Spark DataFrame plans."""
