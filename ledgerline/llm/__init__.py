"""Operators of a training-data pipeline: BPE, near and exact de-duplication,
quality, decontamination, WARC, secrets, toxicity, LM scores, token counts.

Nothing else in the library imports this subpackage; its queries and their SQL
are in :mod:`ledgerline.llm.queries`.
"""
