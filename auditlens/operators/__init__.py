"""Audit operators: DataFrame -> DataFrame functions."""
