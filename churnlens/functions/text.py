"""Text standardisation: strip all whitespace, then title-case like Python's ``str.title``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlens.functions._util import as_col


# Characters Python's str.strip() removes: Unicode White_Space plus the ASCII separators
# U+001C..U+001F, which Python also treats as whitespace.
_WS = r"[\p{IsWhite_Space}\x{1C}-\x{1F}]"


def strip_ws(c) -> Column:
    """Remove leading and trailing whitespace as ``str.strip`` does (``trim`` only removes spaces)."""
    return F.regexp_replace(as_col(c), f"^{_WS}+|{_WS}+$", "")


def title_case(c) -> Column:
    """Like ``str.title``: a cased letter is upper (title) case when the character before it is
    not a cased letter, lower case otherwise.

    ``initcap`` only starts a word after a space, so ``pro-plus`` would stay ``Pro-plus``.
    Strings made of cased letters and spaces only (the usual case) take the cheap ``initcap``
    path; the rest are split after every character that is not a cased letter (digits,
    punctuation, uncased scripts) and each piece is ``initcap``-ed.
    """
    col = as_col(c)
    by_piece = F.array_join(
        F.transform(F.split(col, r"(?<=[^\p{Lu}\p{Ll}\p{Lt}])"), lambda piece: F.initcap(piece)), ""
    )
    return F.when(col.rlike(r"[^\p{Lu}\p{Ll}\p{Lt} ]"), by_piece).otherwise(F.initcap(col))


def clean_text(c) -> Column:
    """strip + title case, the standardisation applied to every categorical column."""
    return title_case(strip_ws(c))


def null_tokens_to_null(c, tokens: Iterable[str]) -> Column:
    """Read the given tokens (exact match) as NULL, as pandas does with its na_values."""
    col = as_col(c)
    return F.when(col.isin(list(tokens)), F.lit(None).cast("string")).otherwise(col)
