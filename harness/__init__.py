"""Registered queries, their oracles and the views both read."""
