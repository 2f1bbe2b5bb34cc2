"""BPE encoding and decoding of whole documents by the tokenization automaton of ``bpe``.

Every text is split as the tokenizer file says and each word is spelled by table-driven automaton
steps; decoding emits the arc labels.  One pass, no shuffle: documents are independent, so a lost
executor costs only the tasks it held.  Only the tokenizer file (its size is the bound) is broadcast.

Null and empty texts have no ids and decode to the empty text; ids may repeat; other columns are
not read.  Special strings inside texts become their ids, as the library does by default.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import labels, read_spec, working_codec
from .common import batches, int_lists, two_columns


def encode(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    docs = two_columns(df, id_col, text_col)
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))

    def run(rows):
        c = working_codec(spec.value)
        for ids, texts in batches(rows, "doc_id", "text"):
            packed = [c.packed_ids(t) for t in texts]
            values = np.frombuffer(b"".join(packed), dtype="<u4")
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), int_lists(values, [len(p) // 4 for p in packed])], ["doc_id", "ids"])

    kind = _arrow(docs)
    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, tokenizer_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text that its ids decode to; null ids decode to the empty text."""
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    schema = T.StructType([f for f in df.schema if f.name != out_col] + [T.StructField(out_col, T.StringType())])

    def run(rows):
        c = labels(spec.value)
        for batch in rows:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                ids = part.column(part.schema.get_field_index(ids_col))
                texts = pa.array([c.decode(x) for x in ids.to_pylist()], pa.string())
                keep = [i for i, n in enumerate(part.schema.names) if n != out_col]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in keep), texts], [*(part.schema.names[i] for i in keep), out_col])

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row: ``encode`` and ``decode`` in one Python stage, so a task has one worker."""
    docs = two_columns(df, id_col, text_col)
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    kind = _arrow(docs)

    def run(rows):
        c, names = working_codec(spec.value), labels(spec.value)
        for ids, texts in batches(rows, "doc_id", "text"):
            for at in range(0, len(ids), 250):
                packed = [np.frombuffer(c.packed_ids(t), "<u4") for t in texts[at : at + 250]]
                decoded = pa.array([names.decode(p.tolist()) for p in packed], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + 250], kind), int_lists(np.concatenate(packed), list(map(len, packed))), decoded], ["doc_id", "ids", "decoded"])

    schema = [docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return docs.mapInArrow(run, T.StructType(schema))


def digests(df: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what a round trip gives, as digests."""
    hexed = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256)
    both = round_trip(df, tokenizer_path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), hexed.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _arrow(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema["doc_id"].dataType)
