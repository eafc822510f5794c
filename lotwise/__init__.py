"""Listing-price analytics on Spark: clean, profile, split, fit, score, rank, export."""

from lotwise.params import Params

__all__ = ["Params"]
