"""Operators of a training-data pipeline: filters, near duplicates, archives, tokens, packing, chat formats."""
