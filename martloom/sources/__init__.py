"""Readers and writers. Connection options always come from the caller."""
