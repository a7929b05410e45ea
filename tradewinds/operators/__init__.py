"""Relational building blocks and the domain operators on top of them."""
