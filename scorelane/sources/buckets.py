"""Keyed tables laid out by buckets of their key: merges and lookups that leave the stored side where it is."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelane.operators.state import merge

BUCKETS = 32
#: Keys of a lookup that are looked for by value in the files; more are joined.
FEW_KEYS = 10_000


class BucketedTable:
    """A table of the session's catalogue, bucketed and sorted by its key, in versions: a merge writes the next one.

    Every version has the same number of buckets, so a join on the key reads the stored side without a shuffle, and a
    lookup by value reads the buckets of its keys alone. A version's table is complete before the name of the current one
    is changed, in a view; versions that are no longer read can be dropped with ``forget``.
    """

    def __init__(self, spark: SparkSession, name: str, key: list[str], path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.name, self.key, self.path, self.buckets = spark, name, key, path.rstrip("/"), buckets
        self.current: str | None = None

    def write(self, rows: DataFrame) -> DataFrame:
        """The next version of the table holds these rows."""
        table = f"{self.name}_{uuid.uuid4().hex}"
        dealt = rows.repartition(self.buckets, *self.key)  # a file a bucket
        dealt.write.format("parquet").bucketBy(self.buckets, *self.key).sortBy(*self.key).option("path", f"{self.path}/{table}").saveAsTable(table)
        self.current, before = table, self.current
        self.before = before
        return self.read()

    def read(self) -> DataFrame:
        return self.spark.table(self.current)

    def forget(self) -> None:
        """Drops the version before the current one."""
        if self.before:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.before}")

    def merged(self, batch: DataFrame, keep: tuple = (), fill: tuple = ()) -> DataFrame:
        """The table after an upsert of a batch with a row a key (see ``merge``): the batch alone is shuffled, to the buckets."""
        return merge(self.read(), batch.repartition(self.buckets, *self.key), self.key, keep, fill)

    def lookup(self, keys: list) -> DataFrame:
        """The rows of a few keys (values, or tuples of them): read from these keys' buckets, the row groups that may hold them."""
        if len(keys) > FEW_KEYS:
            raise ValueError(f"join a table of keys with ``of`` instead of {len(keys)} values")
        if len(self.key) == 1:
            return self.read().where(F.col(self.key[0]).isin(*keys))
        found: Column = F.lit(False)
        for values in keys:
            one: Column = F.lit(True)
            for c, v in zip(self.key, values, strict=True):
                one = one & (F.col(c) == F.lit(v))
            found = found | one
        return self.read().where(found)

    def of(self, keys: DataFrame, how: str = "inner") -> DataFrame:
        """keys joined with their rows; keys alone are shuffled."""
        return keys.repartition(self.buckets, *self.key).join(self.read(), self.key, how)
