"""Text columns: trimming, null tokens, code domains, names."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a field.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# Field texts that mean "no value" in a delimited file.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Case- and accent-insensitive comparison, the warehouse's text collation.
FOLDING_COLLATION = "UNICODE_CI_AI"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Remove white space (not only blanks) from both ends."""
    return F.trim(as_column(value), F.lit(WHITE_SPACE))


def strip_upper(value: Column | str) -> Column:
    return F.upper(strip(value))


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(as_column(value), F.lit(""))


def tokens_to_null(value: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    c = as_column(value)
    return F.when(~c.isin(*tokens), c)


def to_domain(value: Column | str, allowed: Iterable[str], unknown: str | None) -> Column:
    """Keep a code of the allowed set; everything else, null included, becomes ``unknown``."""
    c = as_column(value)
    return F.when(c.isin(*sorted(allowed)), c).otherwise(F.lit(unknown).cast("string"))


def pad_code(value: Column | str, width: int) -> Column:
    """Zero-fill on the left; never truncates, and a sign stays in front."""
    c = strip(value)
    sign = F.regexp_extract(c, r"^[+-]", 0)
    digits = F.substring(c, F.length(sign) + 1, F.length(c))
    room = F.greatest(F.lit(width) - F.length(sign), F.length(digits))
    return F.concat(sign, F.lpad(digits, room, F.lit("0")))


def full_match(value: Column | str, pattern: str) -> Column:
    """Whole-text match; null does not match."""
    return F.coalesce(as_column(value).rlike(rf"^(?:{pattern})$"), F.lit(False))


def is_blank(value: Column | str) -> Column:
    c = as_column(value)
    return c.isNull() | (F.length(c) == 0)


def folded(value: Column | str) -> Column:
    """A join or group key that ignores case and accents.

    Use it on keys only: a collated filter is not pushed down to the files.
    """
    return F.collate(as_column(value), FOLDING_COLLATION)


def joined_label(parts: Sequence[Column | str], separator: str = " / ") -> Column:
    """Parts with a separator; null if any part is null."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(as_column(part).cast("string"))
    return F.concat(*pieces)


def row_json(*columns: str) -> Column:
    """The named columns as a JSON object, nulls written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def content_hash(value: Column | str) -> Column:
    return F.sha2(as_column(value), 256)


def snake_name(name: str) -> str:
    """``Data Registro`` and ``DataRegistro`` both become ``data_registro``."""
    words = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[^A-Z\s_]+|[A-Z]", name)
    return "_".join(word.lower() for word in words)
