"""Row-level operators: quality filters, deduplication, text features, model store."""
