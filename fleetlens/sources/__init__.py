"""Readers and writers: taxi files, zone CSV, event logs, fixture views over the test tables."""
