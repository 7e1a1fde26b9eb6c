"""Operators for large-scale training-data preparation.

Each module holds one operator with a general interface; ``queries`` registers
the thin ``opN_*`` queries on the driver's tables and their SQL.  Nothing
outside this package (and ``corpus_pipeline.py``) imports it.
"""
