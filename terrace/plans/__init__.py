"""Compositions of operators into facts, dimensions, products and runs."""
