"""Whole tables and jobs composed from the operators."""
