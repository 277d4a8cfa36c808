"""Operators for preparing training data: search, language, quality, privacy, copies, mixing, scoring."""
