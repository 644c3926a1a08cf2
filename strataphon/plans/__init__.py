"""Strataphon plans."""
