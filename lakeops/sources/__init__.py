"""Readers and option builders for batch and streaming sources."""
