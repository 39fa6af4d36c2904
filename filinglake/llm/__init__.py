"""Operators of a training-data pipeline: classify, deduplicate, decontaminate, sanitise, pack, shard, archive.

Nothing else in the library imports this subpackage.
"""
