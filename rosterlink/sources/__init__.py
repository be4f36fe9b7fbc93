"""Readers of stored responses and small configuration tables."""
