"""Operators for training-data corpora: scans, cleaning, scoring, deduplication, mixing, tokenising."""
