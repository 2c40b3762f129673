"""Operators of a training-data pipeline: dedup, decontamination, tokenising, extraction, quality.

Nothing else in the library imports this subpackage.
"""
