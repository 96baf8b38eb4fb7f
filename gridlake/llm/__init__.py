"""Preparation of training text: filters, deduplication, mixing, packing, search and token files."""
