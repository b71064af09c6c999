"""Training-data operators: one module per operator, plus their queries.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
