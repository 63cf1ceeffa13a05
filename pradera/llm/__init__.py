"""Training-data operators: dedup, archives, licences, packing, mixing, token counts, classifiers, search.

Each module holds one operator with its general interface; ``queries`` registers one query per operator over the
shared tables, and ``corpus_pipeline`` at the repository top chains five of them.  Nothing outside this package
imports it.
"""
