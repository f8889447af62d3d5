"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic model gives the evidence of each document's own text. Grouped sums of that evidence give a posterior
share of good documents for each host, shrunk towards the whole corpus, and for each path, shrunk towards its
host; how strongly is estimated from the spread between the groups. A document's quality is its own evidence
moved by the posterior of its path, from which its own share has been taken out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed, drawn, hot_join

#: The classifier is fitted on about so many labelled documents at most, drawn by hash.
TRAIN_DOCS = 20_000
#: Documents with less quality than this are rejected.
CUT = 0.5
#: Tables of site posteriors of up to so many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 100_000


FEATURES = [f"__f{k}" for k in range(7)]


def with_features(rows: DataFrame, text_col: str) -> DataFrame:
    """Adds FEATURES, shares and rates of moderate size, 0 for a null or empty text.

    In steps, so that each count is taken once and the generated code stays small.
    """
    text, n = F.col("__text"), F.col("__n")
    counted = rows.withColumn("__text", F.coalesce(F.col(text_col), F.lit(""))).withColumn("__words", F.split(F.trim(text), r"\s+"))
    counted = counted.withColumns(
        {
            "__n": F.length(text).cast("double"),
            "__odd": F.length(F.regexp_replace(text, r"""[^\p{L}\p{N}\s.,;:'"()/-]""", "")),
            "__small": F.length(F.regexp_replace(text, r"\p{Lu}", "")),
            "__plain": F.length(F.regexp_replace(text, r"\p{N}", "")),
            "__many": F.size("__words").cast("double"),
            "__kinds": F.size(F.array_distinct("__words")).cast("double"),
        }
    ).drop("__words", "__text")
    many, kinds = F.col("__many"), F.col("__kinds")
    shares = [10 * (n - F.col("__odd")) / n, 3 * (n - F.col("__small")) / n, 5 * (n - F.col("__plain")) / n]
    shares += [F.log(kinds) / F.log(many + 1), kinds / many, F.log1p(many) / 5, many * 5 / n]
    named = {k: F.when(n > 0, x).otherwise(F.lit(0.0)) for k, x in zip(FEATURES, shares, strict=True)}
    return counted.withColumns(named).drop("__n", "__odd", "__small", "__plain", "__many", "__kinds")


class Evidence:
    """A logistic model of features, as plain numbers."""

    def __init__(self, weights: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.weights, self.mean, self.scale = weights, mean, scale

    def logit(self) -> Column:
        """Of the columns FEATURES."""
        total = F.lit(float(self.weights[0]))
        for x, w, m, s in zip(FEATURES, self.weights[1:], self.mean, self.scale, strict=True):
            part = (F.col(x) - float(m)) / float(s)
            total = total + float(w) * F.greatest(F.lit(-6.0), F.least(F.lit(6.0), part))
        return F.greatest(F.lit(-15.0), F.least(F.lit(15.0), total))


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> Evidence:
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), np.clip((x - mean) / scale, -6, 6)])
    w, penalty = np.zeros(z.shape[1]), ridge * np.eye(z.shape[1])
    penalty[0, 0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z @ w))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Evidence(w, mean, scale)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCS) -> Evidence | None:
    """The model, or None without both good and bad labelled documents."""
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__id"), "quality")
    marks = marks.where(drawn(F.xxhash64("__id", F.lit("train")), most, marks.count()))
    marks = marks.groupBy("__id").agg(F.avg("quality").alias("y"))
    text = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    sample = text.join(F.broadcast(marks), "__id")  # bounded by TRAIN_DOCS
    rows = with_features(sample, "__t").select("y", *FEATURES).toPandas()
    y = rows["y"].to_numpy() if len(rows) else np.zeros(0)
    if not ((y > 0.5).any() and (y <= 0.5).any()):
        return None
    return _fit_logistic(rows.drop(columns="y").to_numpy(float), y)


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, total: float, mean: float) -> float:
    """Pseudo-documents of the prior, by moments: weak where groups differ by more than chance."""
    inside = mean * (1 - mean)
    row = groups.agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - mean, 2)).alias("between"), F.count("*").alias("k"), F.sum(F.col("n") * F.col("n")).alias("nn")
    ).first()
    k, effective = row["k"], total - (row["nn"] or 0) / max(total, 1)
    if k < 2 or effective <= 0 or inside <= 0:
        return 1e6
    spread = (row["between"] - (k - 1) * inside) / effective
    return float(min(1e6, max(1.0, inside / spread - 1))) if spread > 0 else 1e6


def _path_strength(paths: DataFrame) -> float:
    """As ``_strength`` for paths (path_good, path_n, host_good, host_n), around each host's own mean: what tells hosts apart is not counted again."""
    own, host = F.col("path_good") / F.col("path_n"), F.col("host_good") / F.col("host_n")
    share = 1 - F.col("path_n") / F.col("host_n")  # adds up to a host's paths less one
    row = paths.agg(
        F.sum(F.col("path_n") * F.pow(own - host, 2)).alias("between"), F.sum(share * host * (1 - host)).alias("chance"),
        F.sum(F.col("path_n") * share).alias("effective"), F.sum(F.col("path_n") * host * (1 - host)).alias("inside"), F.sum("path_n").alias("total"),
    ).first()
    if not row["effective"] or not row["inside"]:
        return 1e6
    spread = (row["between"] - row["chance"]) / row["effective"]
    return float(min(1e6, max(1.0, row["inside"] / row["total"] / spread - 1))) if spread > 0 else 1e6


class Sites:
    """Sums of evidence: host and path groups with their sizes, and the prior of each level."""

    def __init__(self, paths: DataFrame, rows: int, mean: float, host_prior: float, path_prior: float):
        self.paths, self.rows, self.mean, self.host_prior, self.path_prior = paths, rows, mean, host_prior, path_prior


def gather(evidence: DataFrame) -> Sites:
    """From rows (site, p) the grouped sums, where a site is a struct (host, path); partial sums come before each shuffle."""
    paths = checkpointed(evidence.groupBy("site").agg(F.sum("p").alias("good"), F.count("*").cast("double").alias("n")))
    hosts = checkpointed(paths.groupBy(F.col("site.host").alias("host")).agg(F.sum("good").alias("host_good"), F.sum("n").alias("host_n"), F.count("*").alias("many")))
    all_ = hosts.agg(F.sum("host_good").alias("good"), F.sum("host_n").alias("n")).first()
    total = all_["n"] or 0.0
    mean = all_["good"] / total if total else 0.5
    named = paths.select("site", F.col("site.host").alias("host"), F.col("good").alias("path_good"), F.col("n").alias("path_n"))
    both = checkpointed(hot_join(named, hosts, "host").drop("host"))
    levels = hosts.select(F.col("host_good").alias("good"), F.col("host_n").alias("n"))
    return Sites(both, both.count(), mean, _strength(levels, total, mean), _path_strength(both))


def with_quality(rows: DataFrame, sites: Sites) -> DataFrame:
    """Adds p_host, p_path and quality to rows with columns site and logit; a hot site's rows stay where they are."""
    if sites.rows <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(sites.paths), "site")
    else:
        joined = hot_join(checkpointed(rows), sites.paths.withColumn("many", F.col("path_n")), "site")
    own = 1 / (1 + F.exp(-F.col("logit")))
    p_host = (F.col("host_good") - own + sites.host_prior * sites.mean) / (F.col("host_n") - 1 + sites.host_prior)
    joined = joined.withColumn("p_host", p_host)
    p_path = (F.col("path_good") - own + sites.path_prior * F.col("p_host")) / (F.col("path_n") - 1 + sites.path_prior)
    joined = joined.withColumn("p_path", p_path)
    moved = F.col("logit") + _logit(F.col("p_path")) - _logit(F.lit(sites.mean))
    return joined.withColumn("quality", 1 / (1 + F.exp(-moved)))


def _sited(docs: DataFrame, model: Evidence | None, id_col: str, text_col: str, host: Column, path: Column) -> DataFrame:
    """Rows (row, id, site, logit): each row of docs in a struct of its own, so that no name of docs matters."""
    site = F.struct(F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path"))
    sited = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), site.alias("site"))
    if model is None:
        return sited.withColumn("logit", F.lit(0.0)).drop("text")
    return with_features(sited, "text").withColumn("logit", model.logit()).drop("text", *FEATURES)


def url_site(url: Column) -> tuple[Column, Column]:
    """Host and first path section of a URL; without a host, both come from the path."""
    host = F.regexp_extract(url, r"^[a-z]+://([^/?#]+)", 1)
    path = F.regexp_extract(F.regexp_replace(url, r"^[a-z]+://[^/?#]+", ""), r"^(/[^/?#]*)", 1)
    return F.when(host == "", path).otherwise(host), path


def score_quality(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT
) -> DataFrame:
    """One row per row of docs: id_col, p_doc, p_host, p_path, quality, kept.

    ``host`` and ``path`` are expressions of docs' columns; nulls form a site of their own. Null texts count as
    empty, very long ones are read whole. Labels without quality or id are left out; several for one document are
    averaged, and a tie counts as bad. A quality of exactly ``cut`` is kept. Without labels of both kinds there is no
    evidence: every document is kept at quality one half or more. Rows with null or repeated ids are scored like others.
    Columns of docs may have any names. Empty tables give no rows.
    """
    model = fit(docs, labels, id_col, text_col)
    rows = checkpointed(_sited(docs, model, id_col, text_col, host, path).select("id", "site", "logit"))
    own = 1 / (1 + F.exp(-F.col("logit")))
    done = with_quality(rows, gather(rows.select("site", own.alias("p"))))
    kept = F.lit(True) if model is None else F.col("quality") >= cut
    return done.select(F.col("id").alias(id_col), own.alias("p_doc"), "p_host", "p_path", "quality", kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of docs with enough quality, columns as they came; cases as in ``score_quality``.

    Reads the texts twice instead of shuffling them (with more sites than BROADCAST_ROWS they are shuffled once).
    """
    model = fit(docs, labels, id_col, text_col)
    if model is None:
        return docs
    rows = _sited(docs, model, id_col, text_col, host, path)
    own = 1 / (1 + F.exp(-F.col("logit")))
    sites = gather(rows.select("site", own.alias("p")))
    return with_quality(rows, sites).where(F.col("quality") >= cut).select("row.*")
