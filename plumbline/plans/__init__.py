"""Whole assessments built from the operators."""
