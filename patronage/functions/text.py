"""Light cleaning of review texts before lexicon scoring; case and punctuation stay."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scalars import as_column

# blanks and word characters in the Unicode sense, spelled out: the engine's own Unicode mode is much slower
BLANK = r"\s\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
#: the same blanks one by one
BLANKS = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# two or more blanks; letters and marks of ASCII, most of a text, are told from blanks by one comparison
BLANK_RUN = rf"[[^!-~]&&[{BLANK}]]{{2,}}"

# fixed patterns, applied in this order, each with what a match cannot do without: a text is looked through for that first, at a
# fraction of the cost; the last two patterns cap repetition instead of removing it
NOISE = (
    (rf"https?://[^{BLANK}]+|www\.[^{BLANK}]+", ("://", "www.")),  # links
    (r"<[^>]+>", ("<",)),  # markup
    (r"&[a-zA-Z]+;|&#\p{Nd}+;", ("&",)),  # entities
    (r"[\r\n\t]+", ("\r", "\n", "\t")),  # line breaks
    (rf"[rR]\$[{BLANK}]?\p{{Nd}}{{1,3}}(?:\.\p{{Nd}}{{3}})*(?:,\p{{Nd}}{{2}})?", ("$",)),  # money
    # order and tracking numbers; what stands before is looked at only behind a digit
    (rf"\p{{Nd}}(?<![{WORD}]\p{{Nd}})\p{{Nd}}{{5,}}(?![{WORD}])", ()),
)
REPEATED_MARKS = (r"([!?.])\1{2,}", "$1$1", ("!!!", "???", "..."))
REPEATED_LETTERS = (r"([a-zA-ZÀ-ÿ])\1{3,}", "$1$1$1", ())
MAY_NEED_COMPOSING = r"[^\x{0}-\x{2FF}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def contains_any(text: Column, marks: Iterable[str]) -> Column:
    return reduce(Column.__or__, [text.contains(mark) for mark in marks])


def beyond_ascii(text: Column) -> Column:
    return F.octet_length(text) > F.length(text)


def replaced(value: Column, pattern: str, by: str, needs: tuple[str, ...] = ()) -> Column:
    """``value`` with the matches of ``pattern`` replaced; every match has one of ``needs`` in it."""
    if not needs:
        return F.regexp_replace(value, pattern, by)
    return let(value, lambda v: F.when(contains_any(v, needs), F.regexp_replace(v, pattern, by)).otherwise(v))


def composed(text) -> Column:
    """Unicode NFC. Only texts with characters that could change leave the JVM."""
    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")

    text = as_column(text)
    changed = F.pandas_udf(compose, T.StringType())(F.when(beyond_ascii(text) & text.rlike(MAY_NEED_COMPOSING), text))
    return F.coalesce(changed, text)


def cleaned(text, compose: bool = True) -> Column:
    """The cleaned text, NULL when nothing is left."""
    value = composed(text) if compose else as_column(text)
    for pattern, needs in NOISE:
        value = replaced(value, pattern, " ", needs)
    for pattern, kept, needs in (REPEATED_MARKS, REPEATED_LETTERS):
        value = replaced(value, pattern, kept, needs)
    # a run of blanks has two spaces, or one of the other blanks
    near, far = (tuple(b for b in BLANKS if b != " " and b.isascii() == here) for here in (True, False))
    single = let(value, lambda v: F.when(contains_any(v, ("  ", *near)) | (beyond_ascii(v) & contains_any(v, far)),
                                         F.regexp_replace(v, BLANK_RUN, " ")).otherwise(v))
    return F.nullif(F.btrim(single, F.lit(BLANKS)), F.lit(""))
