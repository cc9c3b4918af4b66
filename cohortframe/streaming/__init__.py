"""Applying fitted parameter tables to a streaming DataFrame."""
