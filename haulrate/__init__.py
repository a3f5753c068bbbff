"""Freight pricing back-test on Spark DataFrames."""

from haulrate.params import Limits, Params

__all__ = ["Limits", "Params"]
