"""Queries over the test tables, with SQL that computes the same results independently."""
