"""Operators for large training corpora: packing, search, tokenising, extraction, de-duplication, selection, archives.

Nothing outside this folder imports it.
"""
