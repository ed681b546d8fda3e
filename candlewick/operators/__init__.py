"""DataFrame operators: indicators, scans, joins, upserts, summaries, quotes and log reports."""
