"""Operators for building training corpora: de-duplication, fingerprints, scoring, filtering,
mixing, packing and nearest neighbours.

Each operator module has a general function over any DataFrame and its parameters; ``queries``
registers one query per operator over the driver's tables.  Nothing else in the library
imports this sub-package.
"""
