"""Trade analytics on Spark: raw messages to clean trades, candles, marts and health reports."""
