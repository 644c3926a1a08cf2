"""Strataphon operators."""
