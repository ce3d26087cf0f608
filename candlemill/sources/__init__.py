"""Scans and sinks: topic, parquet layers, warehouse tables, staged intermediates."""
