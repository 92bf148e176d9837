"""Operators of a training-data pipeline: packing, dedup, filters, decontamination, token files."""
