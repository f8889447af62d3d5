"""The ingest queue as a stream source whose batches are bounded by messages, not by files."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: Messages of a batch at most, where nothing else is asked for.
MESSAGES_A_BATCH = 10


class Span(InputPartition):
    """Rows lo to hi of a file."""

    def __init__(self, path: str, lo: int, hi: int) -> None:
        self.path, self.lo, self.hi = path, lo, hi


class QueueReader(DataSourceStreamReader):
    """Offsets are numbers of messages: files in order of their arrival, rows in order within a file.

    Files are only ever added, so a number means the same message for ever. The driver reads footers, for the counts;
    messages are read by tasks. Each call for the latest offset goes at most a batch further; after a restart the engine
    first plans its last batch again, which tells where that was.
    """

    def __init__(self, path: str, schema: StructType, most: int) -> None:
        self.path, self.names, self.most, self.at, self.counts = path, schema.fieldNames(), most, None, {}

    def _files(self) -> list[tuple[str, int]]:
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        system, root = fs.FileSystem.from_uri(self.path)
        found = [f for f in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)) if f.is_file and f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", "."))]
        for f in found:
            if f.path not in self.counts:
                self.counts[f.path] = pq.read_metadata(f.path, filesystem=system).num_rows
        return [(f.path, self.counts[f.path]) for f in sorted(found, key=lambda f: (f.mtime_ns, f.path))]

    def initialOffset(self) -> dict:
        return {"message": 0}

    def latestOffset(self) -> dict:
        start = self.at or 0
        self.at = min(start + self.most, sum(n for _, n in self._files()))
        return {"message": self.at}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        lo, hi, first, spans = start["message"], end["message"], 0, []
        if self.at is None:
            self.at = hi
        for path, n in self._files():
            if first < hi and first + n > lo:
                spans.append(Span(path, max(0, lo - first), min(n, hi - first)))
            first += n
        return spans

    def read(self, span: Span) -> Iterator:
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        system, _ = fs.FileSystem.from_uri(self.path)
        rows = pq.read_table(span.path, columns=self.names, filesystem=system, partitioning=None).slice(span.lo, span.hi - span.lo)
        yield from rows.select(self.names).to_batches()

    def commit(self, end: dict) -> None:
        pass


class QueueSource(DataSource):
    """Parquet files of messages below ``path`` as a stream of at most ``messages`` rows a batch; the schema has to be given."""

    @classmethod
    def name(cls) -> str:
        return "messages"

    def schema(self):
        raise ValueError("give the schema of the messages")

    def streamReader(self, schema: StructType) -> QueueReader:
        path = self.options["path"]
        return QueueReader(path if "://" in path else f"file://{path}", schema, int(self.options.get("messages", MESSAGES_A_BATCH)))


def read_messages(spark: SparkSession, path: str, schema: str, messages: int = MESSAGES_A_BATCH) -> DataFrame:
    """The messages of a queue's folder as a stream of bounded batches, oldest first."""
    spark.dataSource.register(QueueSource)
    return spark.readStream.format("messages").schema(schema).option("messages", str(messages)).load(path)
