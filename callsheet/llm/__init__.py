"""Operators for preparing training data: packing, de-duplication, token
counts, quality, personal data, licences and nearest neighbours.

Nothing else in the library imports this package.
"""
