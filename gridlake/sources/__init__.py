"""Readers, manifests, writers and the chunked cube store."""
