"""Operators that prepare text for the training of language models.

Each module holds one operator with a general interface; ``registry`` binds them to the tables
``documents``, ``labels`` and ``embeddings``. Nothing outside this subpackage imports it.
"""
