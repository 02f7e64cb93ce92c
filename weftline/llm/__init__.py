"""Operators for preparing very large training corpora, as Spark jobs.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames; Python code runs inside tasks on Arrow batches (numpy over whole
batches, never a row at a time), and Spark does the partitioning and shuffling.
"""
