"""Column expressions shared by the operators."""

from haulrate.functions.text import contains_text, has_text, match_key, zip5

__all__ = ["contains_text", "has_text", "match_key", "zip5"]
