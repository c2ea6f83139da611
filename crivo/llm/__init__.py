"""Corpus operators for training data: dedup, quality, mixing, sharding, scans and token files.

Every operator takes DataFrames and column names; `catalog` registers one query for each. Nothing outside this
package imports it.
"""
