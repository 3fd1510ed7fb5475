"""Relational building blocks: newest per key, top per group, exact ranks, upsert, vector search."""
