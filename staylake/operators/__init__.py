"""DataFrame-to-DataFrame jobs, independent of where the tables come from."""
