"""Training-data operators: ten operators on corpora, embeddings, pages and recordings.

Nothing outside this subpackage imports it; it imports nothing from the rest of the library.
"""
