"""Operators for building training corpora: filters, duplicates, mixing and sharding of documents."""
