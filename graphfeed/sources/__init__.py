"""Readers, writers and the logical views over the input tables."""
