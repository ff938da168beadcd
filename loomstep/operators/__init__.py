"""DataFrame-to-DataFrame operators over a panel keyed by (symbol_id, date_id, time_id)."""
