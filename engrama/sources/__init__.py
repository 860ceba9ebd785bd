"""Readers and writers: vector files, event logs, versioned table snapshots."""
