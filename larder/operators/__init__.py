"""DataFrame-to-DataFrame operators, grouped by job."""
