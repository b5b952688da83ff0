"""DataFrame operators: schema comparison, counts, reconciliation, loads."""
