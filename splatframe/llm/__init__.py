"""Training-data operators: media features, search, language models, packing, dedup, encoding and scans.

Nothing outside this subpackage imports it.
"""
