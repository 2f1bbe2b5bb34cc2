"""Token-id files: concatenated ids with Elias-Fano encoded document boundaries.

Documents are put in ascending doc_id order by a range partitioning, encoded, and written as blocks
(one Parquet row each, so that any store Spark writes to will do).  A block holds

* ``ids``: the ids of its documents one after another, 2 or 4 bytes each (``id_width``);
* ``ends_*``: the Elias-Fano code of the documents' end positions;
* ``keys_*``: the same for the doc_ids, less the smallest (rows of null doc_id come first, counted).

Elias-Fano of m non-decreasing numbers below u keeps ``low`` bits of each as they are and the rest in
unary, 2 + log2(u / m) bits a number.  ``Boundaries.select`` returns any one of them, and
``Boundaries.between`` a stretch, by a sample every 64 ones and a scan from there; no table of 64-bit
offsets is kept.

A block also holds how many ids of its partition lie before it (``before``).  Only partition totals reach
the driver (one number for each partition): they give each partition's first position, and readers add
the two, so reading moves nothing between tasks.  Equal doc_ids are ordered by a hash of their text, so that one doc_id on many rows
does not land in one task.  Null and empty texts hold the end id alone; other columns are not read.
A task that is lost writes its blocks again; a reader sees committed files only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import scratch_path

from .bpe import read_spec, working_codec
from .common import batches, two_columns

END_ID = 1
#: A block ends after the document that brings it to so many ids or documents.
BLOCK_IDS = 1 << 20
BLOCK_DOCS = 1 << 14
SAMPLE = 64
#: Documents whose offsets are read at once.
STRETCH = 1024

_FILE = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("part", "block", "before", "n_docs", "n_nulls", "n_ids", "id_width", "ends_low_bits", "keys_min", "keys_low_bits")]
    + [T.StructField(n, T.BinaryType()) for n in ("ids", "ends_low", "ends_high", "ends_samples", "keys_low", "keys_high", "keys_samples")]
)


class Boundaries:
    """Elias-Fano code of a non-decreasing sequence of non-negative integers."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.samples = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8), np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> Boundaries:
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, int(math.log2(max(top, 1) / n))) if n else 0
        v = values.astype(np.uint64)
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        bits = (v[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        return cls(n, low_bits, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes())

    def bytes(self) -> tuple[bytes, bytes, bytes]:
        return self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        for k in range(self.low_bits):
            at = i * self.low_bits + k
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64) << k
        return out

    def select(self, i: int) -> int:
        """Number ``i``: from the sample before it, to the one that is as many ones further on."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, skip = at >> 3, at & 7
        word = int(self.high[byte]) >> skip << skip
        while left >= (ones := word.bit_count()):
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        at = 8 * byte + (word & -word).bit_length() - 1
        return (at - i) << self.low_bits | int(self._low(np.array([i]))[0])

    def between(self, a: int, b: int) -> np.ndarray:
        """Numbers ``a`` to ``b - 1``: from the sample before the first to the sample after the last."""
        if a >= b:
            return np.empty(0, np.int64)
        sample, beyond = a // SAMPLE, -(-b // SAMPLE)
        first = int(self.samples[sample])
        last = int(self.samples[beyond]) if beyond < len(self.samples) else 8 * len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[first >> 3 : (last + 7) >> 3], bitorder="little")) + (first & ~7)
        skip = int(np.searchsorted(ones, first)) + a - sample * SAMPLE
        i = np.arange(a, b)
        return (ones[skip : skip + b - a] - i) << self.low_bits | self._low(i)


def write(df: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the token files of all rows to the folder ``path``; doc_id must be an integer column."""
    docs = two_columns(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    end = int(end_id).to_bytes(4, "little")
    tie = F.xxhash64("text")
    ordered = docs.withColumn("tie", tie).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")

    def run(rows):
        c = working_codec(spec.value)
        part, block, before, keys, held, total = TaskContext.get().partitionId(), 0, 0, [], [], 0
        for ids, texts in batches(rows, "doc_id", "text"):
            for i, t in zip(ids, texts):
                held.append(c.packed_ids(t) + end)
                keys.append(i)
                total += len(held[-1]) // 4
                if total >= BLOCK_IDS or len(keys) >= BLOCK_DOCS:
                    yield _block(part, block, before, keys, held)
                    block, before, keys, held, total = block + 1, before + total, [], [], 0
        if keys:
            yield _block(part, block, before, keys, held)

    ordered.mapInArrow(run, _FILE).write.mode("overwrite").parquet(path)


def _block(part: int, block: int, before: int, keys: list, held: list[bytes]) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(held), "<u4")
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    known = [k for k in keys if k is not None]
    least = known[0] if known else 0
    ends = Boundaries.of(np.cumsum([len(h) // 4 for h in held], dtype=np.int64))
    labels = Boundaries.of(np.array([k - least for k in known], dtype=np.uint64))
    row = [part, block, before, len(keys), len(keys) - len(known), len(ids), width, ends.low_bits, least, labels.low_bits, ids.astype(f"<u{width}").tobytes(), *ends.bytes(), *labels.bytes()]
    return pa.RecordBatch.from_arrays([pa.array([x], pa.binary() if isinstance(x, bytes) else pa.int64()) for x in row], _FILE.names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files, ids as unsigned 32-bit numbers.

    ``start`` counts the ids of all documents before it, over all files."""
    blocks = spark.read.schema(_FILE).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # one row a partition
    bases, base = {}, 0
    for r in parts:
        bases[r["part"]] = base
        base += r["n"]
    first = spark.sparkContext.broadcast(bases)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):  # one block at a time
                r = batch.slice(k, 1).to_pylist()[0]
                ids = np.frombuffer(r["ids"], f"<u{r['id_width']}").astype("<u4", copy=False)
                ends = Boundaries(r["n_docs"], r["ends_low_bits"], r["ends_low"], r["ends_high"], r["ends_samples"])
                labels = Boundaries(r["n_docs"] - r["n_nulls"], r["keys_low_bits"], r["keys_low"], r["keys_high"], r["keys_samples"])
                start, packed = first.value[r["part"]] + r["before"], ids.tobytes()
                for a in range(0, r["n_docs"], STRETCH):
                    b = min(a + STRETCH, r["n_docs"])
                    stops = ends.between(a, b)
                    starts = np.concatenate([[ends.select(a - 1) if a else 0], stops[:-1]])
                    known = labels.between(max(a - r["n_nulls"], 0), max(b - r["n_nulls"], 0)) + r["keys_min"]
                    keys = pa.concat_arrays([pa.nulls(b - a - len(known), pa.int64()), pa.array(known, pa.int64())])
                    texts = pa.array([packed[4 * s : 4 * e] for s, e in zip(starts.tolist(), stops.tolist())], pa.binary())
                    yield pa.RecordBatch.from_arrays([keys, pa.array(starts + start), pa.array(stops - starts), texts], ["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(df: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the files to the shared folder and read them back: doc_id, start, n_tokens, ids_crc32."""
    spark = df.sparkSession
    path = scratch_path(spark, "token-files")
    write(df, path, tokenizer_path)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
