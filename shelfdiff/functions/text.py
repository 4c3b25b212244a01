"""Text functions. Native where Spark has the semantics, Arrow-batched where it has not."""

from __future__ import annotations

import html
import html.entities
import re
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfdiff import fixed_values as fixed

# White space as Python sees it: Java's Unicode class plus the four separators it leaves out.
SPACE = r"[\s\x1c-\x1f]"
_RUNS = f"(?U){SPACE}+"
_ENDS = rf"(?U)\A{SPACE}+|{SPACE}+\z"

# White space as the browser sees it.
_PAGE_SPACE = r"[\t-\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]+"

# ASCII, Latin-1 letters and precomposed Hangul: NFKC leaves these alone and lower() agrees
# between Python and the JVM, so such names never leave the JVM.
_STABLE = r"\A[\x00-\x7FÀ-ÿ가-힣]*\z"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _ENDS, "")


def collapse(c: Column) -> Column:
    """Runs of white space to one space, ends trimmed."""
    return F.trim(F.regexp_replace(c, _RUNS, " "))


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


@F.pandas_udf(T.StringType())
def _nfkc_lower(names: pd.Series) -> pd.Series:
    spaces = re.compile(r"\s+")
    return names.map(
        lambda s: spaces.sub(" ", unicodedata.normalize("NFKC", s)).strip().lower(),
        na_action="ignore")


def normalize_name(c: Column) -> Column:
    """NFKC, one space between words, lower case. POS prefixes stay: they tell sizes apart."""
    stable = c.rlike(_STABLE)
    return F.when(stable, F.lower(collapse(c))).otherwise(_nfkc_lower(F.when(~stable, c)))


def split_pos_prefix(c: Column) -> Column:
    """``샐)이름`` -> struct(prefix, rest). For display only, never for matching."""
    pattern = rf"(?U)\A([^()\s\x1c-\x1f]{{1,4}})\){SPACE}*"
    found = c.rlike(pattern)
    return F.struct(
        F.when(found, F.regexp_extract(c, pattern, 1)).alias("prefix"),
        F.when(found, F.regexp_replace(c, pattern, "")).otherwise(c).alias("rest"))


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio; the order is (current, previous), it is not symmetric."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.StringType())
def _unescape_any(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


@F.pandas_udf(T.StringType())
def _unescape_closed(texts: pd.Series) -> pd.Series:
    closed = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[0-9A-Za-z]+);")

    def decoded(found: re.Match) -> str:
        # a name that is not in the table must not be read by a shorter name it begins with
        known = found[0][1] == "#" or found[0][1:] in html.entities.html5
        return html.unescape(found[0]) if known else found[0]
    return texts.map(lambda s: closed.sub(decoded, s), na_action="ignore")


def unescape(c: Column, closed: bool = False) -> Column:
    """HTML entities; the everyday ones natively, the full table through Arrow.

    Browsers also read some names without their semicolon, as a text cut inside ``&amp;`` ends; ``closed`` takes such
    names as the text they are.
    """
    left_over = F.regexp_replace(c, "&(?:lt|gt|quot|amp|nbsp|#39);", "").contains("&")
    common = c
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                         ("&nbsp;", "\u00a0"), ("&amp;", "&")):
        common = F.replace(common, F.lit(entity), F.lit(char))
    full = _unescape_closed if closed else _unescape_any
    return F.when(left_over, full(F.when(left_over, c))).otherwise(common)


def clean_text(c: Column, closed: bool = False) -> Column:
    """Unescape, collapse white space, empty to null."""
    return null_if_empty(collapse(unescape(c, closed)))


def strip_markup(c: Column, closed: bool = False) -> Column:
    """Tags to spaces, then clean_text; signs such as the registered mark stay."""
    return clean_text(F.regexp_replace(c, fixed.MARKUP_TAG, " "), closed)


def clean_episode_suffix(c: Column) -> Column:
    """Drop a trailing ``1편`` / ``2편``."""
    return strip(F.regexp_replace(strip(c), fixed.EPISODE_SUFFIX + r"\z", ""))


def hashtags(c: Column) -> Column:
    """``#a #b`` -> [a, b]; null -> []."""
    parts = F.transform(F.split(unescape(c), "#"), strip)
    return F.coalesce(F.filter(parts, lambda t: t != ""), F.array().cast("array<string>"))


def search_normalize(c: Column) -> Column:
    """Lower case without any white space (the page's search)."""
    return F.regexp_replace(F.lower(c), _PAGE_SPACE, "")


def clip_blurb(c: Column, n: int = 40) -> Column:
    return F.substring(c, 1, n)


def strip_fence(c: Column) -> Column:
    """Take the text out of a Markdown code fence; other text is only trimmed."""
    text = strip(c)
    after_first_line = F.when(F.instr(text, "\n") > 0,
                              F.regexp_replace(text, r"\A[^\n]*\n", "")).otherwise(text)
    before_last_fence = F.when(after_first_line.contains("```"),
                               F.regexp_extract(after_first_line, r"(?s)\A(.*)```", 1)) \
        .otherwise(after_first_line)
    return F.when(text.startswith("```"), strip(before_last_fence)).otherwise(text)


def clip_text(c: Column, n: int) -> Column:
    """Trim; beyond ``n`` characters keep the head and say how long the whole was."""
    text = strip(c)
    note = F.format_string(fixed.CLIP_NOTE, F.length(text))
    return F.when(F.length(text) <= n, text).otherwise(F.concat(F.substring(text, 1, n), note))


def flag(c: Column, kind: str) -> Column:
    """Source flags to booleans.

    ``yes``: trimmed, any case ``Y``; ``exact_t``: exactly ``T``; ``visible``: an inline style
    that does not hide the node; ``new_prefix``: a name that begins with ``[NEW]``;
    ``present``: any visible text.
    """
    if kind == "yes":
        found = F.upper(strip(c)) == "Y"
    elif kind == "exact_t":
        found = c == "T"
    elif kind == "visible":
        found = ~F.replace(c, F.lit(" "), F.lit("")).contains("opacity:0")
    elif kind == "new_prefix":
        found = c.startswith("[NEW]")
    elif kind == "present":
        found = strip(c) != ""
    else:
        raise ValueError(f"unknown flag kind: {kind}")
    return F.coalesce(found, F.lit(False))


def any_badge(badges: Column, wanted: str = "NEW") -> Column:
    """True when the badge array holds ``wanted``."""
    return F.coalesce(F.exists(badges, lambda b: b == wanted), F.lit(False))


def category_path(*levels: Column) -> Column:
    """Trimmed levels joined with `` > ``; a missing level is an empty one."""
    return F.concat_ws(" > ", *[F.coalesce(strip(level), F.lit("")) for level in levels])
