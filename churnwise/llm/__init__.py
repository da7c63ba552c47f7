"""Operators for preparing training text: near copies, decontamination, quality, personal data, tokens, archives."""
