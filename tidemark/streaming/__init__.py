"""Streaming shell around the batch operators."""
