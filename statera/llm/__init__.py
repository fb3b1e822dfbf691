"""Operators of a training-data pipeline: cleaning, sampling, scans, fingerprints, models, dedup.

Nothing else in the library imports this subpackage. Its queries are in ``queries``, their SQL in
``oracles``.
"""
