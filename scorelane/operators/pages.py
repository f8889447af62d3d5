"""Discovery on listing pages, page summaries, artifact metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelane.functions.html import absolute, challenge_markers, page_title

MATCH_LINK = r'(?i)href="([^"]*/matches/\d+/[^"]+)"'
DEFAULT_CAP = 20
SAMPLE = 10


def links(html: Column, base: str, pattern: str = MATCH_LINK, distinct: bool = True) -> Column:
    """Links of a page as absolute URLs, the first of equal ones, in page order."""
    found = F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), lambda u: absolute(u, base))
    return F.array_distinct(found) if distinct else found


def discover(pages: DataFrame, base: str, pattern: str = MATCH_LINK, cap: int | None = DEFAULT_CAP, key: str = "page_id") -> DataFrame:
    """Rows (key, pos, link): up to ``cap`` links a page, in page order."""
    found = links(F.col("html"), base, pattern)
    found = F.slice(found, 1, cap) if cap else found
    return pages.select(key, F.posexplode(found).alias("pos", "link"))


def take_until_known(items: DataFrame, known: DataFrame, order: str, item: str) -> DataFrame:
    """The items before the first one, in order, that is known already."""
    seen = items.join(known.select(item).distinct(), item, "left_semi").agg(F.min(order).alias("stop"))
    return items.crossJoin(F.broadcast(seen)).where(F.col("stop").isNull() | (F.col(order) < F.col("stop"))).drop("stop")  # one row


def frontier(found: DataFrame, known: DataFrame, item: str = "link") -> DataFrame:
    """Distinct items that are not known yet."""
    return found.select(item).distinct().join(known.select(item), item, "left_anti")


def match_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/matches/(\d+)", 1), F.lit("")).cast("long")


def match_slug(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/matches/\d+/([^/?#]+)", 1), F.lit(""))


def match_url(base: str, url: Column, number: Column) -> Column:
    """The URL if given, else one for the number; a number of 0 counts as none."""
    return F.coalesce(F.nullif(url, F.lit("")), F.when(number != 0, F.concat(F.lit(base), F.lit("/matches/"), number.cast("string"), F.lit("/_"))))


def summary(pages: DataFrame, base: str, pattern: str = MATCH_LINK, url: Column | None = None) -> DataFrame:
    """Per page: title, challenge markers, number and sample of links, characters and bytes.

    With ``url``, only pages of results (/results within it) are searched for links.
    """
    html, found = F.col("html"), links(F.col("html"), base, pattern)
    if url is not None:
        found = F.when(F.contains(url, F.lit("/results")), found).otherwise(F.slice(found, 1, 0))
    return pages.select(
        "page_id",
        page_title(html).alias("title"),
        (F.size(challenge_markers(html)) > 0).alias("challenge"),
        F.size(found).cast("long").alias("n_links"),
        F.array_join(F.slice(found, 1, SAMPLE), " ").alias("sample"),
        F.length(html).cast("long").alias("html_chars"),
        F.octet_length(html).cast("long").alias("html_bytes"),
    )


def html_key(number: Column, at: Column) -> Column:
    """raw-html/YYYY/MM/DD/<number>_<instant>.html, with dashes for colons and dots."""
    stamp = F.translate(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), ":.", "--")
    return F.concat(F.lit("raw-html/"), F.date_format(at, "yyyy/MM/dd/"), number.cast("string"), F.lit("_"), stamp, F.lit(".html"))


def demo_key(number: Column, url: Column) -> Column:
    """demos/<number>/<last section of the URL, or number.dem>."""
    name = F.coalesce(F.nullif(F.element_at(F.split(url, "/"), -1), F.lit("")), F.concat(number.cast("string"), F.lit(".dem")))
    return F.concat(F.lit("demos/"), number.cast("string"), F.lit("/"), name)


def artifacts(pages: DataFrame, at: Column, number: str = "page_id", body: str = "html") -> DataFrame:
    """Metadata of stored bodies: key, bytes in UTF-8, SHA-256."""
    return pages.select(number, html_key(F.col(number), at).alias("object_key"), F.octet_length(body).cast("long").alias("byte_size"), F.sha2(body, 256).alias("checksum"))


def keyword_context(texts: DataFrame, key: str, text: str, word: str, before: int = 400, after: int = 1600) -> DataFrame:
    """The surroundings of a word's first place, in any case; no row where it is missing."""
    at = F.instr(F.lower(text), word.lower())
    start = F.greatest(F.lit(1), at - before)
    return texts.where(at > 0).select(key, at.cast("long").alias("at"), F.substring(F.col(text), start, at + after - start).alias("context"))


def round_robin(items: DataFrame, order: str, n: int) -> DataFrame:
    """Deals items to n numbers in turn, in order: by the rank within a range partition and the sizes of those before it."""
    from scorelane.sources.files import checkpointed

    placed = checkpointed(items.repartitionByRange(order).select(F.struct("*").alias("row"), F.col(order).alias("by"), F.spark_partition_id().alias("part")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    sizes = placed.groupBy("part").count().withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0)))
    ranked = placed.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy("by")) - 1)
    ranked = ranked.join(F.broadcast(sizes.select("part", "base")), "part")
    return ranked.select("row.*", F.pmod(F.col("base") + F.col("rank"), F.lit(n)).alias("slot"))


def archive_key(number: Column, at: Column) -> Column:
    """storage/html/<number>_<instant>.html, as the archive names its pages."""
    return F.concat(F.lit("storage/html/"), number.cast("string"), F.lit("_"), F.date_format(at, "yyyy-MM-dd_HH-mm-ss"), F.lit(".html"))


def iso_instant(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
