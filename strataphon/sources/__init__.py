"""Strataphon sources."""
