"""Training-data operators: decontamination, language ID, deduplication, packing, quality, extraction.

Nothing outside this folder imports it.  ``vela.llm.queries`` registers one
query per operator; ``corpus_pipeline.py`` chains five of them.
"""
