"""Relational operators: cleaning, ordered windows, history, profiles, text."""
