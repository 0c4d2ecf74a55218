"""Operators for preparing training text: filters, dedup, scoring, mixing, packing, sharding."""
