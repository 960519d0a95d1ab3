"""Operators for training-data pipelines: quality rules, extraction, token
counts, licence and secret scans, deduplication, decontamination,
tokenisation and sharding. Nothing outside this subpackage imports it."""
