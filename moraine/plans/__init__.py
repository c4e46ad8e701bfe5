"""Whole jobs built from the sources, operators and catalog functions."""
