"""Training-data operators: ten operators on documents, pages, conversations and embeddings.

Nothing else in the library imports this package; ``llm/queries.py`` registers its queries.
"""
