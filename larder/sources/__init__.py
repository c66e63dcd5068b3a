"""Table readers, writers and the adapter for the supplied test tables."""
