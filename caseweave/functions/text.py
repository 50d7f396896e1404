"""Text and time expressions. All of them are JVM-side column expressions, but for full entity decoding."""

from __future__ import annotations

import html
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from caseweave.functions import lexicon
from caseweave.schema import to_long_id

# Unicode whitespace and word characters, spelled out so that the JVM's ASCII defaults do not apply.
SPACE = r"\t-\r\x1c-\x1f\x85\p{Z}"
WORD = r"\p{L}\p{N}_"

# The entities that HTML serialisers emit for text; the ampersand goes last so that nothing decodes twice.
BASIC_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"),
)


@F.pandas_udf(T.StringType())
def _decode_entities(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def unescape_html(text: Column, full: bool = True) -> Column:
    """Decode HTML entities.

    ``full`` covers every named and numeric entity; only texts that hold an ampersand travel to a Python worker.
    Otherwise the six basic entities are replaced inside the JVM.
    """
    if full:
        return F.coalesce(_decode_entities(F.when(F.contains(text, F.lit("&")), text)), text)
    for entity, char in BASIC_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def mask_urls(text: Column) -> Column:
    return F.regexp_replace(text, rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+", " <URL> ")


def mask_mentions(text: Column) -> Column:
    return F.regexp_replace(text, rf"@[{WORD}]+", " <USER> ")


def squeeze(text: Column) -> Column:
    """Collapse runs of whitespace to one blank and strip the ends."""
    return F.trim(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def clean_text(text: Column, full_entities: bool = True) -> Column:
    decoded = unescape_html(F.coalesce(text, F.lit("")), full_entities)
    return squeeze(mask_mentions(mask_urls(decoded)))


def normalize(text: Column) -> Column:
    return squeeze(F.lower(F.coalesce(text, F.lit(""))))


def clean_reply(text: Column) -> Column:
    """A support reply without links and numeric mentions; null gives the empty string."""
    text = F.coalesce(text, F.lit(""))
    text = F.regexp_replace(text, rf"https?://[^{SPACE}]+", "")
    return squeeze(F.regexp_replace(text, r"@\p{Nd}+", ""))


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike(rf"[^{SPACE}]")


def parse_created_at(value: Column) -> Column:
    """``Tue Nov 28 07:06:03 +0000 2017`` to a timestamp, anything else to null. The weekday is not parsed."""
    return F.try_to_timestamp(F.substring(value, 5, 26), F.lit("MMM dd HH:mm:ss Z yyyy"))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(rf"[^{SPACE}]+"))


def contains_any(text: Column, phrases: Sequence[str]) -> Column:
    """True when the lower-cased text holds one of ``phrases`` as a substring."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    flag = F.lit(False)
    for phrase in phrases:
        flag = flag | F.contains(lowered, F.lit(phrase))
    return flag


def asks_for_dm(text: Column) -> Column:
    return contains_any(text, lexicon.DM_SIGNALS)


def apologises(text: Column) -> Column:
    return contains_any(text, lexicon.APOLOGY_SIGNALS)


def signals_resolution(text: Column) -> Column:
    return contains_any(text, lexicon.RESOLUTION_SIGNALS)


def speaker_of(inbound: Column, customer: str = "customer", support: str = "support") -> Column:
    """Speaker label; an unknown direction has no speaker."""
    return F.when(inbound, customer).when(~inbound, support)


def split_ids(value: Column) -> Column:
    """``"3, 4.0,x"`` to ``[3, 4]``: blanks and non-integers are dropped."""
    parts = F.transform(F.split(F.coalesce(value, F.lit("")), ","), to_long_id)
    return F.filter(parts, lambda part: part.isNotNull())


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def as_percent(ratio: Column) -> Column:
    return F.format_string("%.2f%%", F.bround(ratio * 100, 2))


def shorten(text: Column, limit: int = 600) -> Column:
    return F.left(text, F.lit(limit))


def words(text: Column) -> Column:
    """Lower-cased words of at least two word characters, in order."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(rf"[{WORD}]{{2,}}"), F.lit(0))


def seeded_order(seed: int, *ids: Column) -> Column:
    """A repeatable pseudo-random sort key, the same in every engine."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.concat_ws("|", *[i.cast("string") for i in ids])).cast("binary"))
