"""Composable ``DataFrame -> DataFrame`` operators for ``df.transform``."""
