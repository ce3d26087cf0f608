"""Operators that prepare a text corpus for training: quality, safety, copies, mixing, output."""
