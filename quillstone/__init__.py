"""Provenance-preserving entity, event and graph analytics as Spark plans."""
