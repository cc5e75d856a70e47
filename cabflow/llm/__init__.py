"""Operators for large training corpora; see the README's section on them."""
