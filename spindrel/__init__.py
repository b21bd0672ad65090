"""Catalogue resolution and link-health analytics expressed as Spark plans."""
