"""Market-data analytics on Spark: bars, indicators, watchlists and live quotes as DataFrame functions."""
