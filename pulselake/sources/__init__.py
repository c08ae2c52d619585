"""Readers and encoders for the raw layer."""
