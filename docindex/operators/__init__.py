"""DataFrame operators: writes and ops-log replay, reads and search, aggregations, ranks."""
