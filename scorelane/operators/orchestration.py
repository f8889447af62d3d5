"""Discovery runs as tables: messages of a schedule, pages of a listing, locks, run ledger, enqueued and inline work, retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelane.operators.messages import DISCOVER, OPTIONS, session_key

#: Markers of errors that a second try may cure, notes of an ingest, and the statuses of an endpoint's answers.
TRANSIENT = ("Attempted to use detached Frame", "Execution context was destroyed", "Cannot find context with specified id")
NOTES = ("RAW_HTML persistence disabled for this request", "Acquired via ", "Browser final URL differed from requested URL: ")
BAD_REQUEST, CHALLENGED, FAILED, DONE = 400, 503, 500, 200
#: A scheduled discovery takes so many matches; a listing has so many a page.
SCHEDULED_MAX, PAGE_STEP = 20, 100
LAUNCH_TRIES, SNAPSHOT_TRIES = 3, 2


def results_url(page_url: Column, base: str) -> Column:
    """The page that is asked for, or the listing of all results."""
    return F.coalesce(F.nullif(page_url, F.lit("")), F.lit(f"{base}/results"))


def scheduled_messages(ticks: DataFrame, cron: str, at: str = "at") -> DataFrame:
    """One discovery message as JSON for each tick of a schedule."""
    stamp = F.unix_millis(F.col(at).cast("timestamp")).cast("string")
    payload = F.struct(
        F.lit(f"cron:{cron}").alias("source"),
        F.lit("browser-session").alias("acquisitionMode"),
        F.concat(F.lit("cron-"), stamp).alias("browserSessionKey"),
        F.lit(SCHEDULED_MAX).alias("maxMatches"),
    )
    return ticks.select(at, F.to_json(F.struct(F.lit(DISCOVER).alias("type"), payload.alias("payload"))).alias("body"))


def discovery_message(page_url: Column, options: dict[str, Column] | None = None) -> Column:
    """A discovery message as JSON; only known options are copied."""
    fields = [page_url.alias("pageUrl")] + [c.alias(k) for k, c in (options or {}).items() if k in (*OPTIONS, "maxMatches")]
    return F.to_json(F.struct(F.lit(DISCOVER).alias("type"), F.struct(*fields).alias("payload")))


def enqueue(messages: DataFrame, path: str) -> bool:
    """Appends messages to a queue's folder; nothing is written for none."""
    if messages.isEmpty():
        return False
    messages.write.mode("append").parquet(path)
    return True


def paginated(listed: DataFrame, key: str, offset: str, pos: str, item: str, most: int) -> DataFrame:
    """The distinct items of each key's listing, read by pages of rising offset, up to ``most``.

    Reading ends at the first page that is missing, empty or without a new item. Rows have key, offset, pos and item (null
    for an empty page). An item counts at its first place; where reading ends follows from each page's number of first
    places alone, so that no page is read in turn.
    """
    first = listed.where(F.col(item).isNotNull()).groupBy(key, item).agg(F.min(F.struct(offset, pos)).alias("at"))
    first = first.select(key, item, F.col(f"at.{offset}").alias(offset), F.col(f"at.{pos}").alias(pos))
    grown = first.groupBy(key, offset).agg(F.count("*").alias("fresh"))
    pages = listed.select(key, offset).distinct().join(grown, [key, offset], "left")
    w = Window.partitionBy(key).orderBy(offset)
    halted = F.col("fresh").isNull() | (F.col(offset) != (F.row_number().over(w) - 1) * PAGE_STEP)
    pages = pages.withColumn("halted", halted.cast("int"))
    pages = pages.withColumns({"over": F.max("halted").over(w), "before": F.sum("fresh").over(w) - F.col("fresh")})
    read = pages.where("over = 0").select(key, offset, "before")
    within = Window.partitionBy(key, offset).orderBy(pos)  # one page
    placed = first.join(read, [key, offset]).withColumn("place", F.col("before") + F.row_number().over(within) - 1)
    return placed.where(F.col("place") < most).select(key, item, F.col("place").cast("long").alias("place"))


def discovery_runs(requests: DataFrame, found: DataFrame, acquired: str = "acquired", failed: str = "failed") -> tuple[DataFrame, DataFrame]:
    """(runs, work) of discovery requests.

    Requests have run_id, source, acquisition_mode, browser_session_key, ``acquired`` (of the crawl lock) and ``failed``;
    found has run_id and link. A scheduled run without the lock is ``skipped`` and does nothing. Links of a browser session
    with a key are ingested inline, one after the other; others are enqueued. A failure ends a run as ``error``, and the
    lock that a scheduled run holds is released whatever its end.
    """
    cron = F.coalesce(F.col("source").startswith("cron"), F.lit(False))
    skipped = cron & ~F.coalesce(F.col(acquired), F.lit(False))
    inline = F.coalesce((F.col("acquisition_mode") == "browser-session") & (F.trim("browser_session_key") != ""), F.lit(False))
    state = F.when(skipped, "skipped").when(F.coalesce(F.col(failed), F.lit(False)), "error").otherwise("success")
    marked = requests.withColumns({"status": state, "way": F.when(inline, "inline").otherwise("enqueued"), "released": cron & ~skipped})
    work = found.join(marked.where("status = 'success'").select("run_id", "way", session_key(F.col("browser_session_key")).alias("session")), "run_id")
    many = work.groupBy("run_id").agg(F.count_if(F.col("way") == "inline").alias("n_inline"), F.count_if(F.col("way") == "enqueued").alias("n_enqueued"))
    runs = marked.join(many, "run_id", "left").select(
        "run_id", "status", "released", F.coalesce("n_inline", F.lit(0)).alias("n_inline"), F.coalesce("n_enqueued", F.lit(0)).alias("n_enqueued")
    )
    return runs, work.select("run_id", "link", "way", "session")


def run_counters(attempts: DataFrame, run: str, ok: Column) -> DataFrame:
    """Successes and failures of each run."""
    good = F.coalesce(ok, F.lit(False))
    return attempts.groupBy(run).agg(F.count_if(good).alias("success"), F.count_if(~good).alias("failed"))


def launch_retry(status: Column, attempt: Column) -> Column:
    """Whether a browser launch is tried again: after too many requests only, and up to three tries."""
    return F.coalesce((status == 429) & (attempt < LAUNCH_TRIES), F.lit(False))


def snapshot_retry(message: Column, attempt: Column) -> Column:
    """Whether a snapshot is tried again: after a transient error only, and up to two tries."""
    transient = F.exists(F.array(*map(F.lit, TRANSIENT)), lambda m: F.contains(message, m))
    return F.coalesce(transient & (attempt < SNAPSHOT_TRIES), F.lit(False))


def backoff_seconds(kind: Column, attempt: Column, wait: float, first: float) -> Column:
    """The wait before try ``attempt`` + 1: constant after proxy or TLS errors, else doubling."""
    return F.when(kind.isin("proxy", "ssl"), F.lit(float(wait))).otherwise(first * F.pow(F.lit(2.0), attempt - 1))


def ingest_notes(stored: Column, mode: Column, requested: Column, final: Column) -> Column:
    """What is to be said of an ingested page: that it was not stored, how it was acquired if not plainly, where it led."""
    unlike = F.when((mode != "") & (mode != "http"), F.concat(F.lit(NOTES[1]), mode))
    moved = F.when(final != requested, F.concat(F.lit(NOTES[2]), final))
    return F.array_compact(F.array(F.when(~stored, NOTES[0]), unlike, moved))


def answer(error: Column, challenge: Column, failed: Column) -> Column:
    """Status and JSON envelope of an endpoint's answer: a bad body first, then a challenge, then a failure."""
    status = F.when(error.isNotNull(), BAD_REQUEST).when(challenge, CHALLENGED).when(failed.isNotNull(), FAILED).otherwise(DONE)
    said = F.coalesce(error, F.when(challenge, F.lit("challenge page")), failed)
    body = F.when(status == DONE, F.to_json(F.struct(F.lit(True).alias("ok")))).otherwise(F.to_json(F.struct(F.lit(False).alias("ok"), said.alias("error"))))
    return F.struct(status.alias("status"), body.alias("body"))


def acquisitions(requests: DataFrame, mode: str = "acquisition_mode", session: str = "browser_session_key") -> DataFrame:
    """How often pages are acquired in each way and session: plainly unless a known mode asks for a browser; sessions have a key."""
    way = F.when(F.col(mode).isin("browser", "browser-session"), F.col(mode)).otherwise("http")
    marked = requests.select(way.alias("way"), F.when(way == "browser-session", session_key(F.col(session))).alias("session"))
    return marked.groupBy("way", "session").agg(F.count("*").alias("n"))


def ingest_outcomes(checked: DataFrame, pages: DataFrame, base: str) -> DataFrame:
    """Adds url and outcome to validated ingest messages: ``done``, ``dropped`` (invalid) or ``retry`` (no page, or a challenge).

    ``checked`` has error, match_url and match_id; ``pages`` a row a url with ``challenge``.
    """
    from scorelane.operators.pages import match_url

    asked = checked.withColumn("url", match_url(base, F.col("match_url"), F.col("match_id")))
    met = asked.join(pages.select(F.col("url").alias("of"), "challenge"), F.col("url") == F.col("of"), "left")
    failed = F.col("url").isNull() | F.coalesce("challenge", F.lit(True))
    return met.withColumn("outcome", F.when(F.col("error").isNotNull(), "dropped").when(failed, "retry").otherwise("done")).drop("of", "challenge")
