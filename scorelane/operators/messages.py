"""Validation and fan-out of queue messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Types of message and the texts of their errors.
DISCOVER, INGEST = "discover-results", "ingest-match"
ERRORS = {
    "shape": "Queue message must contain a type and payload object",
    "type": "Unsupported queue message type",
    "page_url": "Queue discovery job requires a string pageUrl when provided",
    "discover_html": "Queue discovery job requires html to be a string when provided",
    "ingest_key": "Queue ingest job requires either matchUrl or matchId",
    "match_url": "Queue ingest job requires matchUrl to be a string when provided",
    "match_id": "Queue ingest job requires matchId to be numeric when provided",
}
OPTIONS = ("persistHtml", "source", "acquisitionMode", "browserSessionKey")


def _field(body: Column, path: str) -> Column:
    """(kind, text) of a JSON field; kind is null where the field is missing."""
    value = F.try_variant_get(body, f"$.{path}", "variant")
    return F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0)


def validate(messages: DataFrame, body: str = "body") -> DataFrame:
    """Adds type and error (null for a valid message) for messages as JSON text."""
    v = F.try_parse_json(F.col(body))
    kind = lambda p: _field(v, p)
    text = lambda p: F.when(kind(p) == "STRING", F.try_variant_get(v, f"$.{p}", "string"))
    number = lambda p: kind(p).isin("BIGINT", "DOUBLE", "DECIMAL")
    type_ = text("type")
    shape = (F.coalesce(kind("payload"), F.lit("")) != "OBJECT") | type_.isNull()
    wrong_text = lambda p: kind(p).isNotNull() & ~kind(p).isin("VOID") & (F.coalesce(text(p), F.lit("")) == "")
    wrong_number = kind("payload.matchId").isNotNull() & ~kind("payload.matchId").isin("VOID") & ~number("payload.matchId")
    has_key = (F.coalesce(text("payload.matchUrl"), F.lit("")) != "") | F.coalesce(number("payload.matchId"), F.lit(False))
    discover, ingest = type_ == DISCOVER, type_ == INGEST
    error = (
        F.when(v.isNull() | shape, ERRORS["shape"])
        .when(~(discover | ingest), ERRORS["type"])
        .when(discover & wrong_text("payload.pageUrl"), ERRORS["page_url"])
        .when(discover & wrong_text("payload.html"), ERRORS["discover_html"])
        .when(ingest & ~has_key, ERRORS["ingest_key"])
        .when(ingest & wrong_text("payload.matchUrl"), ERRORS["match_url"])
        .when(ingest & wrong_number, ERRORS["match_id"])
    )
    return messages.withColumns({"type": type_, "error": error})


def fan_out(urls: DataFrame, url: str, options: dict[str, Column] | None = None) -> DataFrame:
    """One ingest message as JSON per URL, with the options copied."""
    fields = [F.col(url).alias("matchUrl")] + [c.alias(k) for k, c in (options or {}).items() if k in OPTIONS]
    return urls.select(url, F.to_json(F.struct(F.lit(INGEST).alias("type"), F.struct(*fields).alias("payload"))).alias("body"))


def positive_integer(value: Column) -> Column:
    """The value if it is a whole number above 0, else null."""
    return F.when((value > 0) & (value == F.floor(value)), value.cast("long"))


def session_key(value: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit("default"))


def retry_after_ms(value: Column) -> Column:
    seconds = value.try_cast("double")
    return F.when(seconds > 0, F.ceil(seconds * 1000)).otherwise(F.lit(1000)).cast("long")


def dead_letters(messages: DataFrame, failed: Column) -> DataFrame:
    """Adds outcome: ``done``, ``dropped`` (invalid, acknowledged) or ``retry``."""
    return messages.withColumn("outcome", F.when(F.col("error").isNotNull(), "dropped").when(failed, "retry").otherwise("done"))


#: The modes of acquisition, and the errors of request bodies.
MODES = ("http", "browser", "browser-session")
BODY_ERRORS = {
    "ingest": ("Match ingest body must be an object", "Expected either matchUrl or matchId"),
    "discover": ("Results discovery body must be an object",),
    "demo": ("Demo ingest body must be an object", "Demo ingest requires a numeric matchId", "Demo ingest requires rawDemoUrl", "Demo ingest requires demoR2Key"),
}
_INGEST = ("matchUrl", "matchId", "html", "persistHtml", "acquisitionMode", "browserSessionKey")
_DISCOVER = ("pageUrl", "html", "acquisitionMode", "browserSessionKey", "maxMatches")
_DEMO = ("matchId", "rawDemoUrl", "demoR2Key", "downloadFileName", "contentType", "byteSize")


def optional_text(v: Column, path: str) -> Column:
    """A JSON field as text if it is text and not empty, else null."""
    return F.when(_field(v, path) == "STRING", F.nullif(F.try_variant_get(v, f"$.{path}", "string"), F.lit("")))


def optional_number(v: Column, path: str) -> Column:
    return F.when(_field(v, path).isin("BIGINT", "DOUBLE", "DECIMAL"), F.try_variant_get(v, f"$.{path}", "double"))


def optional_flag(v: Column, path: str) -> Column:
    return F.when(_field(v, path) == "BOOLEAN", F.try_variant_get(v, f"$.{path}", "boolean"))


def optional_mode(v: Column, path: str) -> Column:
    text = optional_text(v, path)
    return F.when(text.isin(*MODES), text)


def _read(v: Column, name: str) -> Column:
    if name in ("matchId", "byteSize"):
        return optional_number(v, name)
    if name == "maxMatches":
        return positive_integer(optional_number(v, name))
    if name == "persistHtml":
        return optional_flag(v, name)
    return optional_mode(v, name) if name == "acquisitionMode" else optional_text(v, name)


def read_requests(bodies: DataFrame, kind: str, body: str = "body") -> DataFrame:
    """Adds ``request`` (a struct of the fields of a body of this kind; null if invalid) and ``error`` (null if valid).

    ``kind`` is ingest, discover or demo. Fields of the wrong type count as missing; JSON that is no object or array is
    an error. The first error in order counts.
    """
    v = F.try_parse_json(F.col(body))
    fields = {"ingest": _INGEST, "discover": _DISCOVER, "demo": _DEMO}[kind]
    shape = F.coalesce(F.regexp_extract(F.schema_of_variant(v), r"^[A-Z]+", 0), F.lit(""))
    errors = BODY_ERRORS[kind]
    error = F.when(~shape.isin("OBJECT", "ARRAY"), errors[0])
    if kind == "ingest":
        error = error.when(optional_text(v, "matchUrl").isNull() & optional_number(v, "matchId").isNull(), errors[1])
    if kind == "demo":
        for field, text in zip(_DEMO, errors[1:], strict=False):
            error = error.when(_read(v, field).isNull(), text)
    request = F.struct(*[_read(v, name).alias(name) for name in fields])
    return bodies.withColumn("error", error).withColumn("request", F.when(F.col("error").isNull(), request))
