"""Relational building blocks that carry a decision about keys, ties or data distribution."""
