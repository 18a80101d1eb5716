"""Lineage analytics on Spark: run events in, catalog-resolved lineage edges out."""
