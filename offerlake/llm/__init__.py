"""Training-data operators: one module per operator, their registered queries in ``queries``.

Nothing outside this folder (but ``__spark_entry__`` behind its guard, and ``corpus_pipeline``) imports it.
"""
