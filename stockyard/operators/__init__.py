"""Relational, statistical and learning operators."""
