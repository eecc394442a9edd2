"""Sources: raw sales files, catalog tables, master data, and the test-table mapping."""
