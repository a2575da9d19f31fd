"""Writers: folders, catalog tables, JDBC, and versioned upsert tables."""
