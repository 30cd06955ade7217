"""Operators for large text corpora; see ``gevel.llm.queries`` for the registered ones."""
