"""Operators for preparing training corpora: quality, licences, secrets, tokens, duplicates, language, leaks."""
