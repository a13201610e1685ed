"""Writers: batch-addressed and versioned lake tables, databases and the log."""
