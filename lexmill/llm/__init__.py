"""Operators for preparing training data: packing, chat, dedup, quality, BPE, HTML, joins, fingerprints, shards.

Nothing else in the library imports this subpackage.
"""
