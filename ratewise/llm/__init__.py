"""Operators of a training-data pipeline (decontamination, packing, token
files, language id, quality, LM scoring, WARC, dedup, token counts).

Nothing else in the package imports this folder.
"""
