"""Operators for preparing language-model training data.

Each module holds one operator with a general interface (DataFrame in,
DataFrame out); :mod:`ledgerlake.llm.queries` applies them to the tables.
Nothing outside this package imports it.
"""
