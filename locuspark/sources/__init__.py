"""Readers: every source is a DataFrame with a declared schema."""
