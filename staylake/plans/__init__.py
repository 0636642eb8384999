"""The views, queries and check SQL that bind the operators to the given tables."""
