"""A saved rank index: a key-ordered copy of a table in which a position is found without a scan.

``build`` writes the rows in key order, a range of keys per file (equal keys may go on in the next one; a task writes
as many files as its rows fill), and beside them a table with one row per
file: its generation, its least and largest key, how many rows it has, and how many rows lie in files before
it.  The row at position ``p`` then is in the one file with ``before <= p < before + n``, at row ``p - before`` of it,
which Parquet's row index gives; ``scan_range``, ``row_at``, ``page`` and ``split_range`` read those files
alone.  The same questions to :mod:`stratum.operators.ordering` scan the table two to four times each.

``append`` adds arriving rows.  Files whose key range meets the range of the new keys are merged with them
into a new generation; all other files stay, only their ``before`` changes.  A version of the index is
a folder that is complete or absent (``_SUCCESS``); readers take the last complete one, so a killed append leaves
the previous version in force, and running it again is safe.  One writer at a time.

Rows with a null key are left out, as by ``select_ranks``.  Keys should be unique; rows with equal keys
are kept, in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.prefix_scan import running_totals
from stratum.sources.versions import complete

ROWS_PER_FILE = 1_000_000
#: Rows that one task sorts and writes, in as many files as they fill; small files need no more tasks.
ROWS_PER_TASK = 250_000
#: Files up to which a read names each.  Spark lists the paths it is given by a job of a task a path and reads
#: small files some thirty a task; more files are read as their folders, by tasks of ``ROWS_PER_TASK`` rows.
NAMED_FILES = 500


def _tasks(rows: int, rows_per_file: int = 0) -> int:
    return max(1, -(-rows // max(rows_per_file, ROWS_PER_TASK)))


def _write_rows(df: DataFrame, key: str, path: str, version: int, rows_per_file: int, total: int | None = None) -> DataFrame:
    """Write a generation of ordered files; returns its index rows without ``before``.  ``total``: the rows with a key, if known."""
    spark = df.sparkSession
    df = df.where(F.col(key).isNotNull())
    tasks = _tasks(df.count() if total is None else total, rows_per_file)
    folder = f"{path}/rows/v{version}"
    ordered = df.repartitionByRange(tasks, key).sortWithinPartitions(key)
    ordered.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(folder)
    rows = spark.read.schema(df.schema).parquet(folder).select(key, "_metadata.file_name").coalesce(tasks)
    where = F.concat(F.lit(f"v{version}/"), F.col("file_name")).alias("file")
    return rows.groupBy(where).agg(F.min(key).alias("least"), F.max(key).alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 0")


def _write_index(files: DataFrame, path: str, version: int) -> None:
    """Write version ``version`` of the index; ``place`` makes the order of files with equal least keys definite."""
    ordered = files.select("file", "least", "largest", "n").withColumn("place", F.struct("least", "largest", "file"))
    ordered = running_totals(ordered, "place", ["n"]).select("file", "least", "largest", "n", F.col("n_below").alias("before"), F.col("n_total").alias("total"))
    ordered.write.mode("overwrite").parquet(f"{path}/index/v{version}")


def build(df: DataFrame, key: str, path: str, rows_per_file: int = ROWS_PER_FILE) -> RankIndex:
    """Write ``df`` in key order below ``path`` (which must be new) and index it."""
    spark = df.sparkSession
    if complete(spark, f"{path}/index"):
        raise ValueError(f"{path} already holds an index; append to it")
    _write_index(_write_rows(df, key, path, 1, rows_per_file), path, 1)
    return RankIndex(spark, path, key, df.schema)


class RankIndex:
    """The last complete version of an index; ``schema`` is the table's."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema):
        done = complete(spark, f"{path}/index")
        if not done:
            raise ValueError(f"{path} holds no index")
        self.spark, self.path, self.key, self.schema, self.version = spark, path, key, schema, done[-1]
        self.files = spark.read.parquet(f"{path}/index/v{self.version}")

    def count(self) -> int:
        """Rows of the table, from the index alone."""
        return self.files.agg(F.coalesce(F.max("total"), F.lit(0))).first()[0]

    def _read(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/rows/{n}" for n in names))

    def _read_whole(self, hit: DataFrame) -> DataFrame | None:
        """All rows of the index's files ``hit``, which are neighbours in key order; None if there are none.

        Many are read as the folders of their generations; a file there that is not wanted is left out by its name, its rows by their keys."""
        found = hit.select("file").limit(NAMED_FILES + 1).collect()
        if len(found) <= NAMED_FILES:
            return self._read([r["file"] for r in found]) if found else None
        folder = F.substring_index("file", "/", 1)
        parts = hit.groupBy(folder.alias("folder")).agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("largest").alias("largest")).collect()  # one row per generation
        frames = []
        for r in parts:
            rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/rows/{r['folder']}")
            rows = rows.where(F.col(self.key).between(F.lit(r["least"]), F.lit(r["largest"]))).withColumn("_file", F.col("_metadata.file_name"))
            here = hit.where(folder == r["folder"]).select(F.substring_index("file", "/", -1).alias("_file"))
            frames.append(rows.coalesce(_tasks(r["n"])).join(F.broadcast(here), "_file", "left_semi").select(*self.schema.names))
        return _union(frames)

    def scan_range(self, offset: int = 0, limit: int | None = None) -> DataFrame:
        """Rows ``[offset, offset + limit)`` in key order (``limit=None``: to the end); reads only the files that hold them.

        The driver looks up the files at the two ends; those between are read whole."""
        start = max(0, offset)
        stop = None if limit is None else start + max(0, limit)
        hit = self.files.where(F.col("before") + F.col("n") > start)
        inside = F.col("before") >= start
        if stop is not None:
            hit = hit.where(F.col("before") < stop)
            inside = inside & (F.col("before") + F.col("n") <= stop)
        whole = self._read_whole(hit.where(inside))
        frames = [] if whole is None else [whole]
        for r in hit.where(~inside).select("file", "before").collect():  # at most two
            place = F.col("_metadata.row_index") + F.lit(r["before"])
            frames.append(self._read([r["file"]]).where((place >= start) & (place < stop) if stop is not None else place >= start))
        return _union(frames or [self._read([])])

    def row_at(self, i: int) -> DataFrame:
        """The i-th row in key order; empty when out of range."""
        return self.scan_range(i, 1) if i >= 0 else self._read([])

    def page(self, page_no: int = 1, size: int | None = 50) -> tuple[DataFrame, int]:
        """Page ``page_no`` (below 1 acts as 1) of ``size`` rows in key order, and the total; no size or ``size <= 0``: all rows."""
        total = self.count()
        if not size or size <= 0:
            return self.scan_range(), total
        return self.scan_range((max(1, int(page_no or 1)) - 1) * size, size).orderBy(self.key), total

    def split_range(self, train_n: int, eval_n: int) -> DataFrame:
        """All rows with ``split``: the first ``train_n`` 'train', the next ``eval_n`` 'eval', the rest 'live'."""
        total = self.count()
        train = min(max(0, train_n), total)
        held = min(max(0, eval_n), total - train)
        parts = ((0, train, "train"), (train, held, "eval"), (train + held, None, "live"))
        return _union([self.scan_range(at, n).withColumn("split", F.lit(name)) for at, n, name in parts])

    def append(self, df: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> RankIndex:
        """Add rows; files whose keys the new ones' range meets are rewritten with them, the others stay."""
        new = df.where(F.col(self.key).isNotNull()).select(*self.schema.names)
        lo, hi, arrived = new.agg(F.min(self.key), F.max(self.key), F.count(F.lit(1))).first()
        if lo is None:
            return self
        meets = (F.col("largest") >= F.lit(lo)) & (F.col("least") <= F.lit(hi))
        merged = self.files.where(meets)
        old = self._read_whole(merged)
        version = self.version + 1
        rows = new if old is None else new.unionByName(old)
        total = arrived + merged.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        files = _write_rows(rows, self.key, self.path, version, rows_per_file, total)
        _write_index(self.files.where(~meets).select("file", "least", "largest", "n").unionByName(files), self.path, version)
        return RankIndex(self.spark, self.path, self.key, self.schema)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
