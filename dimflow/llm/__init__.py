"""Operators of a training-data pipeline: near duplicates, scans, shards,
mixing, tokens and quality.  Nothing else in the library imports this package.
"""
