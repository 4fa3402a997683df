"""Training-data operators: filters, near duplicates, extraction, mixing and audits.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
