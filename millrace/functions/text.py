"""Text predicates and decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_REPLACEMENT = "�"


def contains_text(text: Column, word: str | Column) -> Column:
    """True where ``word`` occurs literally; ``%`` and ``_`` have no special meaning."""
    return F.contains(text, word if isinstance(word, Column) else F.lit(word))


def like_text(text: Column, word: str) -> Column:
    """``LIKE '%word%'``: ``%`` and ``_`` inside ``word`` stay wildcards."""
    return text.like(f"%{word}%")


def drop_bad_utf8(text: Column) -> Column:
    """Remove byte sequences that are no UTF-8, keeping the rest of the line.

    Only lines that fail validation are rewritten, so a genuine replacement character in
    a valid line survives.
    """
    repaired = F.replace(F.make_valid_utf8(text), F.lit(_REPLACEMENT), F.lit(""))
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)
