"""Cohort-wide cell-free DNA fragment analytics on Spark DataFrames."""

from fragloom.params import Params

__all__ = ["Params"]
