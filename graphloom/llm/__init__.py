"""Operators for large text corpora: scans, joins, packing, mixing and storage.

Nothing outside this subpackage imports it.
"""
