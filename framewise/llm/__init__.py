"""Training-data operators: scans, filters, deduplication, mixing, archives and tokenisation."""
