"""Operators for preparing training data: search, dedup, scans, mixing, encoding, scoring.

Each module holds one operator with its own general interface; ``registry`` derives
the registered queries from them. Nothing outside this package imports it.
"""
