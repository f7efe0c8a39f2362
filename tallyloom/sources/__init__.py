"""Readers, writers and progress ledgers."""
