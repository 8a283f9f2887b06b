"""Whole jobs composed from the operators, and the views they run on."""
