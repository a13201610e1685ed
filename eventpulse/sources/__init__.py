"""Readers: the log, landed responses, database tables and lake tables."""
