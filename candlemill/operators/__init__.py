"""DataFrame to DataFrame transforms, without I/O, usable on batch and streaming input."""
