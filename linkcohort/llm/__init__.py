"""Operators for preparing training text: filtering, deduplication, redaction, encoding, archives."""
