"""Keys, prices and URLs as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfdiff import fixed_values as fixed
from shelfdiff.functions.text import strip


def name_hash(name: Column) -> Column:
    return F.concat(F.lit("nh"), F.substring(F.sha1(name), 1, 12))


def surrogate_key(*keys: Column, name: Column, prefix: str | Column | None = None) -> Column:
    """First key that is there, else a hash of the name.

    ``prefix`` keeps apart numbering spaces that would collide; it never goes on the hash.
    """
    present = [F.when(k != "", k) for k in keys]
    if prefix is not None:
        head = F.lit(prefix) if isinstance(prefix, str) else prefix
        present = [F.concat(head, k) for k in present]
    return F.coalesce(*present, name_hash(name))


def make_id(source_id: Column, external_id: Column) -> Column:
    return F.concat(source_id, F.lit("--"), external_id)


def key_from_text(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern`` (alternatives go into the pattern); null without one."""
    found = F.regexp_extract(c, pattern, group)
    return F.when(found != "", found)


def sequence_from_code(c: Column, prefix: str = "RPPZ") -> Column:
    """``RPPZ2275`` -> 2275; anything else -> null, never a guess."""
    digits = F.substring(c, len(prefix) + 1, 2 ** 31 - 1)
    ok = c.startswith(prefix) & digits.rlike(r"\A[0-9]+\z")
    return F.when(ok, digits.try_cast("bigint"))


def barcode_from_url(url: Column) -> Column:
    """File stem up to the first ``_``, if it is 8 to 14 digits."""
    file_name = F.substring_index(url, "/", -1)
    stem = F.regexp_replace(file_name, r"\.[^.]*\z", "")
    head = F.substring_index(stem, "_", 1)
    return F.when(head.rlike(rf"\A{fixed.BARCODE}\z"), head)


def barcode_from_path(url: Column) -> Column:
    """The stricter form: ``/<8-14 digits>.<letters>`` at the end."""
    return key_from_text(url, rf"/({fixed.BARCODE})\.[A-Za-z]+\z")


def price_digits(c: Column) -> Column:
    """Digits with commas only; any other text -> null."""
    bare = strip(F.replace(c, F.lit(","), F.lit("")))
    return F.when(bare.rlike(r"\A[0-9]+\z"), bare.try_cast("bigint"))


def price_search(c: Column) -> Column:
    """First number in free text."""
    run = F.regexp_extract(c, fixed.PRICE_RUN, 0)
    return F.when(run != "", F.replace(run, F.lit(","), F.lit("")).try_cast("bigint"))


def price_float(c: Column) -> Column:
    """``5500.0`` -> 5500; zero or missing -> null, an unknown price is never 0."""
    value = c.try_cast("double")
    return F.when(value != 0, value.cast("bigint"))


def price_by_size(prices: Column, order: tuple[str, ...] = ("M", "L", "?")) -> Column:
    """From a map size -> price the first size present in ``order``."""
    return F.coalesce(*[F.try_element_at(prices, F.lit(size)) for size in order])


def price_lowest(prices: Column) -> Column:
    """Lowest positive price of the variants, each cut to an integer."""
    usable = F.filter(prices, lambda p: p > 0)
    return F.array_min(F.transform(usable, lambda p: p.cast("bigint")))


def absolutize(c: Column, base: str) -> Column:
    """``//x`` -> ``https://x``; ``http…`` as it is; other paths under ``base``."""
    return (F.when(c.isNull() | (c == ""), F.lit(None).cast("string"))
            .when(c.startswith("//"), F.concat(F.lit("https:"), c))
            .when(c.startswith("http"), c)
            .otherwise(F.concat(F.lit(base), c)))


def prefixed_url(path: Column, prefix: Column) -> Column:
    """``prefix + path`` when both are there; a path that is a URL needs no prefix."""
    path, prefix = strip(path), strip(prefix)
    return (F.when(path == "", F.lit(None).cast("string"))
            .when(path.startswith("http"), path)
            .when(prefix != "", F.concat(prefix, path)))


def percent_encode(c: Column) -> Column:
    """Percent-encode a path, keeping ``/`` (form encoding differs in four places)."""
    out = F.url_encode(c)
    for form, path in (("+", "%20"), ("%2F", "/"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(form), F.lit(path))
    return out


def percent_decode(c: Column) -> Column:
    """Decode a slug; a plus sign is a plus sign, not a space."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def template_url(template: str, *keys: Column, fallback: Column | None = None) -> Column:
    """Fill ``%s`` places; null (or ``fallback``) as soon as one key is missing."""
    complete = F.lit(True)
    for key in keys:
        complete = complete & key.isNotNull() & (key.cast("string") != "")
    url = F.format_string(template, *[k.cast("string") for k in keys])
    return F.when(complete, url).otherwise(fallback if fallback is not None else F.lit(None))


def conditional_image(display: Column, key: Column, template: str) -> Column:
    """An image exists only when the display flag says ``Y``."""
    return F.when((display == "Y") & key.isNotNull() & (key != ""),
                  F.format_string(template, key))


def real_image(c: Column) -> Column:
    """A path, unless it is empty or carries the word ``null``."""
    return F.when((c != "") & ~c.contains("null"), c)


def css_url(c: Column) -> Column:
    """The address inside an inline ``url(...)``."""
    return strip(key_from_text(c, fixed.CSS_ADDRESS))


def format_price(c: Column) -> Column:
    """``1234`` -> ``1,234원``."""
    return F.when(c.isNotNull(), F.concat(F.format_number(c, 0), F.lit(fixed.WON)))
