"""Packing of documents into fixed-length token sequences: first-fit decreasing in randomised groups.

``pieces`` encodes each document (ids by the tokenizer, then an end id) and cuts it every
``length`` ids.  ``place`` deals the pieces to groups by a hash of a row's position and the piece's
start, so neither copies of one row nor one long document meet in one group.  Each group packs on
its own by first-fit decreasing; a tournament tree over the bins' free room finds the first bin that
fits in log(bins) steps.  ``sequences`` joins ids and places into packed sequences.

Only (key, length, digest) is shuffled for placing, never ids or texts.  Full pieces are sequences of their
own; a group holds the last pieces of about ``GROUP_DOCS`` documents, whatever the input's or a document's size.  Ties in length go by doc_id, then start, then
digest.  Null and empty texts are one end id; repeated rows are packed each; other columns are not
read.  Only the tokenizer file is broadcast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import cut_lineage

from .bpe import read_spec, working_codec
from .bpe_documents import _arrow
from .common import batches, two_columns

LENGTH = 2048
END_ID = 1
GROUP_DOCS = 4096


def pieces(df: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, doc_tokens, row, ids): ids as little-endian unsigned 32-bit numbers.

    ``row`` tells documents apart, also those of one doc_id."""
    docs = two_columns(df, id_col, text_col)
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    kind, end = _arrow(docs), int(end_id).to_bytes(4, "little")

    def run(rows):
        c = working_codec(spec.value)
        row = (TaskContext.get().partitionId() << 38) - 1
        for ids, texts in batches(rows, "doc_id", "text"):
            out = []
            for i, t in zip(ids, texts):
                row += 1
                packed = c.packed_ids(t) + end
                n = len(packed) // 4
                for at in range(0, n, length):
                    part = packed[4 * at : 4 * (at + length)]
                    out.append((i, at, len(part) // 4, n, row, part))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *(pa.array(x, pa.int64()) for x in cols[1:5]), pa.array(cols[5], pa.binary())], names)

    names = ["doc_id", "start", "length", "doc_tokens", "row", "ids"]
    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in names[1:5]), T.StructField("ids", T.BinaryType())]))


def first_fit_decreasing(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in it) of each item; the items come in falling length.

    Tournament tree: a node holds the most free room below it; going left whenever the left
    child has enough finds the first bin that fits."""
    n = len(lengths)
    whole = int(np.searchsorted(-lengths, -room, side="right"))  # full ones: a bin each
    if whole:
        bins, offsets = first_fit_decreasing(lengths[whole:], room)
        return np.concatenate([np.arange(whole), bins + whole]), np.concatenate([np.zeros(whole, np.int64), offsets])
    leaves = 1 << max(0, (n - 1).bit_length())
    tree = [room] * (2 * leaves)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for i, size in enumerate(lengths.tolist()):
        at = 1
        while at < leaves:
            at *= 2
            if tree[at] < size:
                at += 1
        bins[i], offsets[i] = at - leaves, room - tree[at]
        tree[at] -= size
        at >>= 1
        while at:
            tree[at] = max(tree[2 * at], tree[2 * at + 1])
            at >>= 1
    return bins, offsets


def place(parts: DataFrame, n_docs: int, length: int = LENGTH, group_docs: int = GROUP_DOCS, seed: int = 1) -> DataFrame:
    """``parts``, a written table, with (sequence_id, offset); needs doc_id, start, length, row; other columns stay.

    A full piece is a sequence of its own and meets no group; so a group holds the last pieces of about ``group_docs``
    documents, however long those are.  A group's sequence ids hold the group above 31 bits for the
    sequence in it; those of full pieces are negative."""
    groups = max(1, -(-n_docs // group_docs))
    schema = T.StructType([*parts.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "row", "start"], ascending=[False, True, True, True])
        bins, offsets = first_fit_decreasing(part["length"].to_numpy(), length)
        return part.drop(columns="pack_group").assign(sequence_id=(part["pack_group"].to_numpy() << 31) + bins, offset=offsets)

    whole = parts.where(F.col("length") >= length).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    dealt = parts.where(F.col("length") < length).withColumn("pack_group", F.pmod(F.xxhash64("row", "start", F.lit(seed)), F.lit(groups)))
    return dealt.groupBy("pack_group").applyInPandas(run, schema).unionByName(whole)


def sequences(parts: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences, ids joined in offset order, without padding.

    ``parts`` should be a written table (``packed`` does that): rows that are numbered anew would not meet their places."""
    keys = ["row", "start"]
    held = parts.select(*keys, "ids").join(placed.select(*keys, "sequence_id", "offset", "length"), keys)
    one = held.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return one.select("sequence_id", "n_tokens", F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def packed(df: DataFrame, tokenizer_path: str) -> DataFrame:
    """(sequence_id, n_tokens, ids) of all rows: pieces written once, placed, and joined."""
    parts = cut_lineage(pieces(df, tokenizer_path), "pieces")
    placed = cut_lineage(place(parts.drop("ids"), df.count()), "places")
    return sequences(parts, placed)


def layout(df: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    parts = cut_lineage(pieces(df, tokenizer_path).withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    placed = place(parts, df.count())
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
