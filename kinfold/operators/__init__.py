"""Relational and graph operators."""
