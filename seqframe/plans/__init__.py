"""Whole jobs composed from the operators: build a dataset, convert, validate, audit."""
