"""The library's operators bound to the TPC-H-like test tables, each with independent SQL."""
