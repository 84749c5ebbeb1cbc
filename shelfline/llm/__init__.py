"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface; ``registry``
holds the thin queries over the test tables. Nothing outside this folder
(and ``corpus_pipeline.py``) imports it.
"""
