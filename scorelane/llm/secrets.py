"""Secret scans: fixed patterns, and a battery of randomness tests, in DataFrame functions alone.

Candidate runs are tested under the encoding that their characters suggest, by the places of their symbols in its
alphabet. Three tests ask whether a run could have been drawn at random: chi-squared uniformity over the alphabet, the
number of runs of high and low symbols, and the serial correlation of neighbours; Simes' rule makes them one p-value,
and a run that it rejects is no secret. The null hypothesis of a discovery is the other one, that the run was written:
then its letters have the frequencies of prose, vowels and consonants alternate, and small letters, capitals and digits
come in stretches. Its p-value is held by Benjamini-Hochberg within classes of length, over all candidates of the corpus.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed

#: Fixed by the contract: kind, pattern, group that the length counts, shortest length; order is that of output.
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: What is cheap to look for before the pattern itself; a text without it has no match that is long enough. Looking behind
#: spares the search from trying each place within a run.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
HINTS = {"hex": r"(?<![0-9a-f])[0-9a-f]{24}", "access": r"AKIA[A-Z0-9]{16}", "random": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20}"}
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
KIND_RANDOM = "random"
_DIGITS, _CAPITALS, _SMALL = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Encodings, smallest alphabet first, with the order of their symbols: a candidate has the first that holds its characters.
ALPHABETS = (
    ("hex_lower", _DIGITS + "abcdef"),
    ("hex_upper", _DIGITS + "ABCDEF"),
    ("base32", _CAPITALS + "234567"),
    ("base36", _DIGITS + _CAPITALS),
    ("base36_lower", _DIGITS + _SMALL),
    ("base64", _CAPITALS + _SMALL + _DIGITS + "+/"),
    ("base64url", _CAPITALS + _SMALL + _DIGITS + "-_"),
    ("mixed", _CAPITALS + _SMALL + _DIGITS + "+/-_"),
)
#: Letters of English prose, in per mille.
LETTERS = {
    "a": 82, "b": 15, "c": 28, "d": 43, "e": 127, "f": 22, "g": 20, "h": 61, "i": 70, "j": 2, "k": 8, "l": 40, "m": 24,
    "n": 67, "o": 75, "p": 19, "q": 1, "r": 60, "s": 63, "t": 91, "u": 28, "v": 10, "w": 24, "x": 2, "y": 20, "z": 1,
}
VOWELS = "aeiouy"
#: Share of vowels in prose after a vowel, after a consonant, and at the start of a stretch of letters.
VOWEL_AFTER = {"v": 0.2, "c": 0.6, "-": 0.4}
#: Letters of a text depend on its words: the variance of their likelihood is taken so many times as large.
INFLATION = 1.3
FDR = 0.05
LEVEL = 0.001
#: Share of neighbours of different kinds (small letter, capital, digit) in written text: two a stretch of ten where
#: the encoding has one case, two a word of six or seven letters where it has both (capitals within names).
CHANGES = {"hex_lower": 0.2, "hex_upper": 0.2, "base32": 0.2, "base36": 0.2, "base36_lower": 0.2}
CHANGES_MIXED = 0.3


def _written_powers(symbols: int) -> tuple[float, float]:
    """Sums of squares and cubes of the symbol frequencies of written hexadecimal runs (numbers, dates, counters): falling as 1/(rank + 3)."""
    weights = [1 / (k + 3) for k in range(min(symbols, 26))]
    total = sum(weights)
    return sum((w / total) ** 2 for w in weights), sum((w / total) ** 3 for w in weights)


SPAN = "start:int,end:int,kind:string,ord:int"


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """array<struct<start, end, kind, ord, value>> of one kind: leftmost matches, positions in code points.

    The pieces between the matches come from ``split`` and the matches from ``regexp_extract_all``; the same
    engine finds the same matches, so their lengths add up to positions.
    """
    spans = f"array<struct<{SPAN},value:string>>"
    rows = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("g"),
        F.split(text, pattern, -1).alias("gap"),
    )
    order = [k for k, *_ in KINDS].index(kind) if kind != KIND_RANDOM else len(KINDS)

    def step(acc, r):
        start = acc["at"] + F.length(r["gap"])
        end = start + F.coalesce(F.length(r["m"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), F.lit(order).alias("ord"), r["m"].alias("value"))
        out = F.when(F.length(r["g"]) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.cast(spans).alias("out"))

    nothing = F.array().cast(spans)
    found = F.aggregate(rows, F.struct(F.lit(0).alias("at"), nothing.alias("out")), step, lambda acc: acc["out"])
    lowered = F.lower(text)
    hint = reduce(Column.__or__, [F.contains(lowered, F.lit(n)) for n in NAMES]) if kind == "assign" else text.rlike(HINTS[kind])
    return F.when(hint, found).otherwise(nothing)


def _normal_below(z: Column) -> Column:
    """P(Z <= z) by the polynomial of Abramowitz and Stegun 26.2.17."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-z * z / 2) / 2.5066282746310002 * poly
    return F.when(z >= 0, 1 - tail).otherwise(tail)


def _let(value: Column, use) -> Column:
    """use(value), with value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _reach(count: Column, among: Column, share: Column) -> Column:
    """P(X >= count) of a binomial X by the saddle point with a correction for whole numbers: one formula for all lengths.

    Within a tenth of the exact sum down to 1e-50, and within a step or two of the grid where discoveries are decided.
    """
    density = lambda z: F.exp(-z * z / 2) / 2.5066282746310002

    def at(a: Column) -> Column:
        y, n, p = a["y"], a["n"], a["p"]
        t = F.log(y * (1 - p) / (p * (n - y)))
        return _let(F.struct(y.alias("y"), n.alias("n"), p.alias("p"), t.alias("t"), F.sqrt(n * p * (1 - p)).alias("spread")), signed)

    def signed(a: Column) -> Column:
        y, n, p, t = a["y"], a["n"], a["p"], a["t"]
        r = F.signum(t) * F.sqrt(F.greatest(2 * (t * y - n * F.log(1 - p + p * F.exp(t))), F.lit(1e-300)))
        u = 2 * F.sinh(t / 2) * F.sqrt(y * (n - y) / n)
        flat = F.abs(t) < 0.02  # there the limit
        z = F.when(flat, (y - n * p) / a["spread"]).otherwise(r)
        skew = F.when(flat, -(1 - 2 * p) / a["spread"] / 6 * (1 - z * z)).otherwise(1 / u - 1 / r)
        return _let(F.struct(z.alias("z"), skew.alias("skew")), lambda b: _normal_below(-b["z"]) + density(b["z"]) * b["skew"])

    tail = _let(F.struct((count - 0.5).alias("y"), among.alias("n"), share.alias("p")), at)
    return F.when((among < 1) | (count <= 0), F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))


def letter_costs() -> dict[str, tuple[dict[str, float], float, float]]:
    """By what comes before (v, c, or - for no letter): -log of the chance of each letter, and the mean and variance of that."""
    group = {x: sum(w for c, w in LETTERS.items() if (c in VOWELS) == (x == "v")) for x in "vc"}
    out = {}
    for before, vowel in VOWEL_AFTER.items():
        chance = {c: (vowel if c in VOWELS else 1 - vowel) * w / group["v" if c in VOWELS else "c"] for c, w in LETTERS.items()}
        cost = {c: -math.log(p) for c, p in chance.items()}
        mean = sum(chance[c] * cost[c] for c in cost)
        out[before] = cost, mean, sum(chance[c] * (cost[c] - mean) ** 2 for c in cost)
    return out


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def _by_encoding(of) -> Column:
    """The double that ``of`` gives for the alphabet of each encoding."""
    return F.coalesce(*[F.when(F.col("encoding") == name, F.lit(float(of(symbols)))) for name, symbols in ALPHABETS])


def test_battery(candidates: DataFrame, value: str = "value") -> DataFrame:
    """Adds encoding, n, p_uniform, p_runs, p_serial, p_random, p_letters, p_changes, p to rows with a string column of two characters or more.

    p_uniform: chance that a random string of this length and alphabet has so large a chi-squared statistic.
    p_runs, p_serial: two-sided chance, for a random string, of so odd a number of runs of symbols above or below the
    middle of the alphabet, and of so large a correlation of neighbours.
    p_random: the three by Simes' rule (small: not random).
    p_letters: chance that written text has so unlikely letters; in hexadecimal, that it repeats so few symbols.
    p_changes: chance that written text changes so often between small letters, capitals and digits.
    p: the two together, by Fisher's product (small: not written).
    """
    v, n, k = F.col(value), F.col("n"), F.col("__k")
    quoted = lambda symbols: "^[" + symbols.replace("-", r"\-") + "]+$"
    c = candidates.withColumns(
        {
            "encoding": F.coalesce(*[F.when(v.rlike(quoted(symbols)), F.lit(name)) for name, symbols in ALPHABETS]),
            "n": F.length(v).cast("double"),
            "__s": F.filter(F.split(v, ""), lambda x: F.length(x) > 0),
        }
    )
    alphabet = F.coalesce(*[F.when(F.col("encoding") == name, F.lit(symbols)) for name, symbols in ALPHABETS])
    c = c.withColumns({"__k": _by_encoding(len), "__alphabet": alphabet})
    middle = (k - 1) / 2
    many = lambda s: n - F.size(F.array_remove(F.col("__s"), s))
    pairs = F.aggregate(F.array_distinct("__s"), F.lit(0.0), lambda acc, s: acc + many(s) * (many(s) - 1) / 2)
    c = c.withColumns(
        {
            "__d": F.transform("__s", lambda x: F.instr(F.col("__alphabet"), x).cast("double") - 1 - middle),
            "__pairs": pairs,
            "__all": n * (n - 1) / 2,
        }
    )
    # chi-squared against k equal cells is 2k/n times the equal pairs, plus k - n: its tail is that of the pairs
    c = c.withColumn("p_uniform", _reach(F.col("__pairs"), F.col("__all"), 1 / k))
    following = F.slice("__d", F.lit(2), F.greatest(F.size("__d") - 1, F.lit(0)))
    change = lambda a, b: F.when(a.isNull() | b.isNull(), 0.0).when((a > 0) != (b > 0), 1.0).otherwise(0.0)
    c = c.withColumn("__mean", _total(F.col("__d")) / n)
    around = lambda x: x - F.col("__mean")
    c = c.withColumns(
        {
            "__above": F.size(F.filter("__d", lambda d: d > 0)).cast("double"),
            "__runs": 1 + _total(F.zip_with(following, "__d", change)),
            "__ss": _total(F.transform("__d", lambda d: around(d) * around(d))),
            "__lag": _total(F.zip_with(following, "__d", lambda a, b: F.coalesce(around(a) * around(b), F.lit(0.0)))),
        }
    )
    mu = 2 * F.col("__above") * (n - F.col("__above")) / n + 1
    var = (mu - 1) * (mu - 2) / (n - 1)
    two_sided = lambda z: 2 * _normal_below(-F.abs(z))
    serial = (F.col("__lag") / F.nullif(F.col("__ss"), F.lit(0.0)) + 1 / n) * F.sqrt(n)
    c = c.withColumn("p_runs", F.when(var > 0, two_sided((F.col("__runs") - mu) / F.sqrt(var))).otherwise(F.lit(0.0)))
    c = c.withColumn("p_serial", F.coalesce(two_sided(serial), F.lit(0.0)))
    low, high = F.least("p_uniform", "p_runs", "p_serial"), F.greatest("p_uniform", "p_runs", "p_serial")
    middle_p = F.col("p_uniform") + F.col("p_runs") + F.col("p_serial") - low - high
    c = c.withColumn("p_random", F.least(3 * low, 1.5 * middle_p, high))

    # the null of a discovery: letters
    costs = letter_costs()
    small = F.lower(v)
    vowels, consonants = VOWELS, "".join(x for x in _SMALL if x not in VOWELS)
    kinds = F.translate(F.regexp_replace(small, "[^a-z]", "-"), vowels + consonants, "v" * len(vowels) + "c" * len(consonants))
    before = F.concat(F.lit("-"), kinds)
    table = F.create_map(*[F.lit(x) for b, (cost, _, _) in costs.items() for letter, w in cost.items() for x in (b + letter, float(w))])
    means = F.create_map(*[F.lit(x) for b, (_, mean, _) in costs.items() for x in (b, float(mean))])
    spreads = F.create_map(*[F.lit(x) for b, (_, _, spread) in costs.items() for x in (b, float(spread))])
    chars = F.filter(F.split(small, ""), lambda x: F.length(x) > 0)
    steps = F.zip_with(F.filter(F.split(before, ""), lambda x: F.length(x) > 0), chars, lambda b, x: F.concat(b, x))
    c = c.withColumn("__steps", F.filter(steps, lambda x: x.rlike("^.[a-z]$")))
    own = lambda table, key: F.transform("__steps", lambda x: F.element_at(table, key(x)))
    first = lambda x: F.substring(x, 1, 1)
    c = c.withColumns({"__cost": _total(own(table, lambda x: x)), "__expected": _total(own(means, first)), "__spread": _total(own(spreads, first))})
    unlikely = _normal_below((F.col("__expected") - F.col("__cost")) / F.sqrt(INFLATION * F.col("__spread")))
    s2, s3 = (F.lit(x) for x in _written_powers(16))
    spread = F.sqrt(2 * n * (n - 1) * (s2 + 2 * (n - 2) * s3 - (2 * n - 3) * s2 * s2))
    few_pairs = _normal_below((2 * F.col("__pairs") - n * (n - 1) * s2) / spread)
    hexadecimal = F.col("encoding").isin("hex_lower", "hex_upper")
    c = c.withColumn("p_letters", F.when(hexadecimal, few_pairs).when(F.size("__steps") > 0, unlikely).otherwise(F.lit(1.0)))

    # and stretches; marks between words are no change: the kinds are those of the letters and digits alone
    kinds = F.translate(F.regexp_replace(v, "[^A-Za-z0-9]", ""), _DIGITS + _CAPITALS + _SMALL, "0" * 10 + "A" * 26 + "a" * 26)
    c = c.withColumn("__among", F.greatest(F.length(kinds) - 1, F.lit(0)).cast("double"))
    c = c.withColumn("__changes", (F.size(F.split(kinds, r"(?<=(.))(?!\1)(?=.)")) - 1).cast("double"))
    share = F.coalesce(*[F.when(F.col("encoding") == e, F.lit(q)) for e, q in CHANGES.items()], F.lit(CHANGES_MIXED))
    c = c.withColumn("p_changes", _reach(F.col("__changes"), F.col("__among"), share))
    product = F.greatest(F.col("p_letters") * F.col("p_changes"), F.lit(1e-300))
    c = c.withColumn("p", product * (1 - F.log(product)))
    return c.drop("__s", "__k", "__alphabet", "__d", "__pairs", "__all", "__mean", "__above", "__runs", "__ss", "__lag", "__steps", "__cost", "__expected", "__spread", "__among", "__changes")


def discoveries(tested: DataFrame, fdr: float = FDR) -> DataFrame:
    """Adds ``secret``: Benjamini-Hochberg on p within classes of length, and p_random not below LEVEL.

    The p-values are rounded up to a grid of 1/100 powers of ten, so that counts per step of the grid suffice;
    classes and steps are bounded, whatever the number of candidates. Rounding up errs to fewer discoveries.
    """
    step = F.greatest(F.lit(-3000), F.ceil(100 * F.log10(F.greatest("p", F.lit(1e-300))))).cast("int")
    classed = tested.withColumns({"__class": F.least(F.floor(F.log2("n") * 2), F.lit(40)).cast("int"), "__step": step})
    grid = classed.groupBy("__class", "__step").agg(F.count("*").alias("__m"))
    w = Window.partitionBy("__class")
    grid = grid.withColumn("__rank", F.sum("__m").over(w.orderBy("__step"))).withColumn("__all", F.sum("__m").over(w))
    holds = F.pow(F.lit(10.0), F.col("__step") / 100) <= fdr * F.col("__rank") / F.col("__all")
    cut = grid.where(holds).groupBy("__class").agg(F.max("__step").alias("__cut"))
    joined = classed.join(F.broadcast(cut), "__class", "left")  # 41 classes at most
    random = F.col("p_random") >= LEVEL
    return joined.withColumn("secret", F.coalesce((F.col("__step") <= F.col("__cut")) & random, F.lit(False))).drop("__class", "__step", "__cut")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """Rows (id_col, base, added), one per row of docs; both are array<struct<start, end, kind, ord>>.

    Spans are sorted by start, then kind; positions are code points, the end is exclusive. Null text counts as
    empty. A candidate has a digit and a letter, and overlaps no base span. Rows with null or repeated ids keep
    their own spans (rows are told apart by a key of their own). Very long texts are scanned whole; an empty
    table gives no rows; columns besides id_col and text_col are not read.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__t"))
    by_start = lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["ord"] - b["ord"])
    base = F.array_sort(F.concat(*[_spans(F.col("__t"), *k) for k in KINDS]), by_start)
    rows = rows.select("__id", base.alias("base"), _spans(F.col("__t"), KIND_RANDOM, CANDIDATE, 0, 20).alias("found"))
    coded = lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")
    apart = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    plain = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), b["kind"].alias("kind"), b["ord"].alias("ord")))
    found = F.filter("found", lambda s: coded(s) & apart(s))
    rows = checkpointed(rows.select("__id", plain.alias("base"), found.alias("found"), F.monotonically_increasing_id().alias("__key")))
    single = rows.where(F.size("found") > 0).select("__key", F.explode("found").alias("span"))
    judged = discoveries(test_battery(single.select("*", F.col("span.value").alias("value"))), fdr).where("secret")
    span = F.struct(*[F.col(f"span.{x}").alias(x) for x in ("start", "end", "kind", "ord")])
    added = judged.groupBy("__key").agg(F.array_sort(F.collect_list(span)).alias("added"))  # of one text each
    nothing = F.array().cast(f"array<struct<{SPAN}>>")
    return rows.join(added, "__key", "left").select(F.col("__id").alias(id_col), "base", F.coalesce("added", nothing).alias("added"))


def _of_kind(kind: str):
    return lambda span: F.when(span["kind"] == kind, True)


def digest_of(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id_col, n_assign, n_access, n_hex, base_sha256, spans. Cases as in ``secret_spans``."""
    found = secret_spans(docs, id_col, text_col)
    many = {f"n_{k}": F.size(F.array_compact(F.transform("base", _of_kind(k)))).cast("long") for k, *_ in KINDS}
    by_start = lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["ord"] - b["ord"])
    every = F.array_sort(F.concat("base", "added"), by_start)
    return found.select(
        id_col, *[c.alias(k) for k, c in many.items()], F.sha2(digest_of(F.col("base")), 256).alias("base_sha256"), digest_of(every).alias("spans")
    )


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str = "n_chars") -> DataFrame:
    """docs with each span (overlapping ones together) replaced by [SECRET]; count_col, if there, is counted anew.

    Spans are found first and joined to the rows by id and the text's hash, so rows that share an id keep apart. Texts without spans, nulls among them, stay as they are. Very long texts are
    treated whole, other columns may have any names, repeated rows stay repeated, and an empty table gives no rows.
    """
    counted = count_col in docs.columns
    count = F.col(count_col) if counted else F.lit(None).cast("long")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), count.alias("count"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("sha"))
    spans = secret_spans(rows.select(F.struct("id", "sha").alias("key"), "text"), "key", "text")
    hit = spans.where(F.size("base") + F.size("added") > 0).select(F.col("key.id").alias("hit_id"), F.col("key.sha").alias("hit_sha"), F.array_sort(F.concat("base", "added")).alias("spans"))
    hit = checkpointed(hit.dropDuplicates(["hit_id", "hit_sha"]))
    joined = rows.join(hit, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("sha") == F.col("hit_sha")), "left")
    text, none = F.col("text"), F.col("spans").isNull()

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(gap))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, F.length(text))))
    done = F.array_join(F.aggregate("spans", start, step, rest), "[SECRET]")
    joined = joined.withColumn("fresh", F.when(none, text).otherwise(done))
    recounted = F.when(none, F.col("count")).otherwise(F.length("fresh").cast(docs.schema[count_col].dataType if counted else "long"))
    changed = {text_col: F.col("fresh")} | ({count_col: recounted} if counted else {})
    return joined.select(*[changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns])
