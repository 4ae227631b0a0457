"""Operators for preparing large text corpora: filters, sketches, mixtures, shards, archives."""
