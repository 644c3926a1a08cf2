"""Strataphon streaming."""
