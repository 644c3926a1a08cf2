"""Strataphon functions."""
