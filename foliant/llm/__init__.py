"""Training-data operators: filters, scanners, deduplication, tokenisation and archives.

Nothing outside this subpackage imports it.
"""
