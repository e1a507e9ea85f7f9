"""Curation, publication-contract and ledger analytics as Spark jobs."""
