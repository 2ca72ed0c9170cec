"""Training-data operators for documents and embeddings.

Nothing outside this package imports it; ``queries.py`` holds the registered
queries, ``oracle.py`` their SQL where SQL can express them.
"""
