"""Model preparation, training, tuning, reports, end-to-end paths and the query catalog."""
