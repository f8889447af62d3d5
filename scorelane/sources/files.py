"""Readers and writers of the engine's files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = ("player_name", "player_id", "side", "game_id", "team1_name", "team2_name", "team1_id", "team2_id", "score1", "score2", "date")


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Stored page snapshots: requested_url, final_url, html, title."""
    return spark.read.parquet(path)


def read_game_rows(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon-separated game rows; lines without exactly 11 fields are dropped."""
    parts = spark.read.text(path).select(F.split("value", ";").alias("f")).where(F.size("f") == len(FIELDS))
    return parts.select(*[F.col("f")[k].alias(name) for k, name in enumerate(FIELDS)])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.length("value") > 0)


def read_demos(spark: SparkSession, path: str) -> DataFrame:
    """Demo files: path, name and size; their content is not read."""
    return spark.read.format("binaryFile").load(path).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"))


def read_table(spark: SparkSession, at: str | dict, name: str | None = None) -> DataFrame:
    """A table as Parquet at a path, or, from a dict of options, by JDBC."""
    if isinstance(at, dict):
        return spark.read.format("jdbc").options(**at, **({"dbtable": name} if name else {})).load()
    return spark.read.parquet(f"{at}/{name}" if name else at)


def append_rows(rows: DataFrame, path: str, place: str = "place") -> None:
    """Appends rows as text with semicolons; their order is in a column of its own, so a reader can take newest or oldest first."""
    rows.select(F.concat_ws(";", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (place, *[x for x in rows.columns if x != place])]).alias("value")).write.mode("append").text(path)


def html_tables(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Cells of the tables of each page: key, table, row, col (from 0) and cell, its text without tags, decoded.

    In column functions alone: tables, rows and cells are exploded one after the other, so a large page is spread over rows.
    A table within a cell ends the outer one.
    """
    from scorelane.functions.html import decoded, trimmed

    parts = lambda text, tag: F.regexp_extract_all(text, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)(?=</?{tag}\b|\z)"), F.lit(2 if "(" in tag else 1))
    t = pages.select(key, F.posexplode(parts(F.col(html), "table")).alias("table", "x"))
    t = t.select(key, "table", F.posexplode(parts(F.col("x"), "tr")).alias("row", "x"))
    t = t.select(key, "table", "row", F.posexplode(parts(F.col("x"), "(td|th)")).alias("col", "x"))
    return t.select(key, "table", "row", "col", decoded(trimmed(F.regexp_replace("x", "<[^>]*>", ""))).alias("cell"))


def snapshots_of(requests: DataFrame, stored: DataFrame, url: str = "url", html: str = "html", also: tuple[str, ...] = ()) -> DataFrame:
    """Adds final_url, html and title to requests: their own html if it is not empty (no title then), else the stored snapshot of their URL.

    A request gives one row. A snapshot is found by its URL and the columns ``also``, which both tables have; of several, the
    greatest by final_url, html and title counts.
    """
    snapshot = F.struct("final_url", "html", "title")
    keys = {url: "requested_url"} | {c: c for c in also}
    kept = stored.groupBy(*[F.col(c).alias(f"{c}__of") for c in keys.values()]).agg(F.max(snapshot).alias("s"))
    inline = F.coalesce(F.col(html), F.lit("")) != ""
    met = requests.join(kept, [F.col(k).eqNullSafe(F.col(f"{c}__of")) for k, c in keys.items()], "left").withColumn("inline", inline)
    own = F.struct(F.col(url).alias("final_url"), F.col(html).alias("html"), F.lit(None).cast("string").alias("title"))
    rest = [c for c in requests.columns if c != html]
    return met.withColumn("s", F.when(F.col("inline"), own).otherwise(F.col("s"))).select(*rest, "inline", "s.*")


def append_predictions(predictions: DataFrame, path: str, run: str) -> None:
    """Appends a run's predictions, with the run's name, to those stored at a path."""
    predictions.withColumn("run", F.lit(run)).write.mode("append").parquet(path)


def publish(tables: dict[str, DataFrame], root: str, version: int) -> str:
    """Writes all tables to a fresh folder each, then a pointer to these for the version; readers see whole versions only.

    A version is published once: a second writer of it fails when it comes to the pointer, and its folders stay unread.
    """
    import uuid

    spark = next(iter(tables.values())).sparkSession
    made = []
    for name, df in tables.items():
        made.append((name, f"{root}/{name}/v={version}-{uuid.uuid4().hex}"))
        df.write.parquet(made[-1][1])
    spark.createDataFrame(made, "name string, path string").coalesce(1).write.mode("error").parquet(f"{root}/_pointer/version={version}")
    return root


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table of the latest version."""
    pointer = spark.read.parquet(f"{root}/_pointer").where(F.col("name") == name)
    return spark.read.parquet(pointer.agg(F.max_by("path", "version")).first()[0])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share; a temporary one in one process."""
    import tempfile
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="scorelane-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df materialised under spark.checkpoint.dir, its lineage cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)
