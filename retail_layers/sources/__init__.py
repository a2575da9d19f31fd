"""Readers: Parquet folders, JSON feeds, tab-separated exports, literal rows."""
