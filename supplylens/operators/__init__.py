"""Operators over domain tables: derivations, windows, joins, actions, text and scoring."""
