"""Whole queries and jobs made of the operators."""
