"""Whole pipelines, and the bindings of test tables to the ride log."""
