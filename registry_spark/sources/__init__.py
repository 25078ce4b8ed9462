"""Readers, lake writers and the run log."""
