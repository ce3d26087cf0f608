"""Streaming runs: each takes what is available, writes it and stops."""
