"""Column functions for text in HTML: captures, numbers, entities, URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that mark a challenge page, in the order in which they are reported.
CHALLENGE_MARKERS = (
    "Just a moment...",
    "Enable JavaScript and cookies to continue",
    "Attention Required! | Cloudflare",
    "/cdn-cgi/challenge-platform/",
    "cf-browser-verification",
    "challenge-platform",
)
#: Entities in the order in which they are replaced; an ampersand first decodes twice.
ENTITIES = (("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"))


def non_empty(text: Column) -> Column:
    """The text, or null if it is empty. NULLIF would work the text out twice."""
    return F.get(F.filter(F.array(text), lambda s: s != ""), F.lit(0))


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, or null if there is none or it is empty."""
    return non_empty(F.regexp_extract(text, pattern, group))


def trimmed(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def decoded(text: Column) -> Column:
    for entity, plain in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def first_of(texts: Column | tuple, *patterns: str) -> Column:
    """The first pattern with a non-empty group; each is sought in the texts in turn (a part that likely holds it, then the whole)."""
    texts = texts if isinstance(texts, tuple) else (texts,)
    return F.coalesce(*[first_group(t, p) for p in patterns for t in texts])


def capture_text(text: Column | tuple, *patterns: str) -> Column:
    """As first_of, trimmed, then decoded."""
    return decoded(trimmed(first_of(text, *patterns)))


def capture_number(text: Column | tuple, *patterns: str) -> Column:
    """As capture_text, without all but digits, dots and minus signs; null if that is no number."""
    digits = F.regexp_replace(capture_text(text, *patterns), "[^0-9.-]", "")
    return non_empty(digits).try_cast("double")


def absolute(url: Column, base: str) -> Column:
    return F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(base), url))


def challenge_markers(html: Column) -> Column:
    return F.filter(F.array(*map(F.lit, CHALLENGE_MARKERS)), lambda m: F.contains(html, m))


def page_title(html: Column) -> Column:
    return non_empty(trimmed(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))


def instant_of_epoch(value: Column) -> Column:
    """Epoch seconds, or milliseconds beyond ten digits, as a timestamp."""
    value = value.cast("long")
    return F.timestamp_millis(F.when(value > 9_999_999_999, value).otherwise(value * 1000))


def origin(url: Column) -> Column:
    """Scheme and host (with a port) of an absolute URL, in small letters; null for any other text."""
    found = F.regexp_extract(url, r"(?i)^([a-z][a-z0-9+.-]*://[^/?#]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def url_path(url: Column) -> Column:
    """The path of an absolute URL, / where it has none; null for any other text."""
    path = F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]+([^?#]*)", 1)
    return F.when(origin(url).isNotNull(), F.coalesce(F.nullif(path, F.lit("")), F.lit("/")))


def with_query(url: Column, parameters: dict[str, Column]) -> Column:
    """The URL with parameters put after those that it has, encoded; null ones are left out, a fragment stays last."""
    pairs = F.array_compact(F.array(*[F.when(v.isNotNull(), F.concat(F.lit(f"{k}="), F.url_encode(v.cast("string")))) for k, v in parameters.items()]))
    plain, fragment = F.regexp_extract(url, r"^([^#]*)", 1), F.regexp_extract(url, r"(#.*)$", 1)
    joint = F.when(F.contains(plain, F.lit("?")), "&").otherwise("?")
    return F.when(F.size(pairs) == 0, url).otherwise(F.concat(plain, joint, F.array_join(pairs, "&"), fragment))
