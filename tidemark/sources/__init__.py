"""Readers and writers. The format and its options are always arguments."""
