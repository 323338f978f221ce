"""Training-data operators: dedup, quality, tokenisation, packing and privacy.

Nothing outside this subpackage imports it.  ``queries`` registers one query per
operator; every other module holds one operator with its general interface.
"""
