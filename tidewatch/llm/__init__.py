"""Operators for preparing training text: output, deduplication, decontamination, tokens, language, toxicity."""
