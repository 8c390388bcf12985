"""Training-data operators: formatting, output files, scans, deduplication, packing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
