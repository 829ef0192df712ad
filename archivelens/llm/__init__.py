"""Operators for preparing language-model training text at scale.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames, keeps its state in Spark and survives the loss of executors.
"""
