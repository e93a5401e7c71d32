"""Operators of a training-data pipeline: duplicates, extraction, scoring, mixing, output."""
