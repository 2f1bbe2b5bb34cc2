"""Similarity join on word shingles: MinHash candidates, Bayesian pruning, exact verification.

1. A text's set of hashed five-word shingles gives a 128-bit set key and a signature of 160 MinHash
   values.  Rows of one set key are one class; only classes are compared.
2. Classes that agree on all five values of one of 32 bands are candidates (a pair of similarity 0.8
   shares no band with probability 3e-6).  Bands of few classes give pairs; a band of many gives one
   edge a member, never all pairs.
3. Pruning compares two signatures a few values at a time.  After k values with m equal, and all
   similarities equally likely beforehand, the posterior probability of reaching the threshold t is
   that of at most m hits in k + 1 draws of chance t.  Below ``TOLERANCE`` the pair is dropped.
4. What is left, with the edges of large bands, falls into neighbourhoods (connected components).  A
   neighbourhood's classes meet in blocks of bounded size; all pairs of a block are pruned as above and
   the rest verified on the shingles themselves.  A block returns sums and a spanning forest, no pairs.
5. Links are summed by class; the forests' components are the result's classes.

``links`` returns one row per document: the class (smallest doc_id of its component) and the number
of other documents linked to it directly, copies counted each.  Null and empty texts have no
shingles and link to nothing.  Texts of fewer than five words are one shingle.  Words are what white
space separates, in lower case.  A null doc_id counts as a document; a class without any id is named
null.  Repeated rows are documents of their own.  Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.clean import SPACE
from stratum.session import cut_lineage

from .bpe import Memo
from .bpe_documents import _arrow
from .common import batches, free_names, text_of, two_columns
from .components import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
STEP = 16
#: Posterior probability of reaching the threshold below which a pair is dropped.
TOLERANCE = 1e-6
#: Classes in a band up to which it gives pairs, and classes in a block of a neighbourhood.
SMALL_BAND = 32
CHUNK = 128

_RNG = np.random.default_rng(20240229)
_MULTIPLY = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_PLACES = _RNG.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8"), digest_size=8).digest(), "little")


@functools.lru_cache(maxsize=1)
def _hashes() -> Memo:
    return Memo(_word_hash, 125_000, "ngrams")


Memo.on_leaving("ngrams", _hashes.cache_clear)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes().__getitem__, tokens), np.uint64, len(tokens))
    n = max(1, len(h) - words + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(words, len(h))):
        out += h[k : k + n] * _PLACES[k]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash values of a shingle set, the low 16 bits of each."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(found), 512):
        part = found[a : a + 512, None] * _MULTIPLY[None, :]
        part += _ADD[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(20)).astype("<u2")


@functools.lru_cache(maxsize=8)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For each number of compared values in steps of STEP, the matches a pair needs to go on."""
    out = []
    for k in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance and m < k:
            m += 1
            total += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
        out.append(m)
    return tuple(out)


def survivors(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which pairs (row left[i] of ``a``, row right[i] of ``b``) of signatures stay after every step."""
    alive, hits = np.arange(len(left)), np.zeros(len(left), np.int32)
    for step, need in enumerate(least_matches(threshold)):
        s = slice(step * STEP, (step + 1) * STEP)
        for at in range(0, len(alive), 1 << 16):
            part = alive[at : at + (1 << 16)]
            hits[part] += (a[left[part], s] == b[right[part], s]).sum(axis=1, dtype=np.int32)
        alive = alive[hits[alive] >= need]
        if not len(alive):
            break
    return alive


def _sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, set_key, n, signature) of every row with shingles, and of those without (n = 0)."""
    kind = _arrow(docs)

    def run(rows):
        Memo.turn_to("ngrams")
        for ids, hashes, texts in batches(rows, "doc_id", "text_hash", "text"):
            sets = [shingles(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, kind),
                    pa.array(hashes, pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array(list(map(len, sets)), pa.int64()),
                    pa.array([signature(s).tobytes() if len(s) else b"" for s in sets], pa.binary()),
                ],
                ["doc_id", "text_hash", "set_key", "n", "signature"],
            )

    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, t) for n, t in (("text_hash", T.LongType()), ("set_key", T.BinaryType()), ("n", T.LongType()), ("signature", T.BinaryType())))])
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema)


def _bands(classes: DataFrame) -> DataFrame:
    """(band, n, lead, cid): members of every band that several classes share."""
    width = 2 * ROWS
    each = classes.select("cid", "signature", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("k"))
    each = each.select("cid", F.xxhash64("k", F.expr(f"substring(signature, k * {width} + 1, {width})")).alias("band"))
    shared = each.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("lead")).where("n > 1")
    # by shuffle: Spark takes the rows after an explode for as few as before it and would broadcast all bands of the corpus
    return cut_lineage(each.join(shared.hint("merge"), "band"), "bands")


def _pruned(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that pruning leaves."""
    held = pairs.join(classes.select(F.col("cid").alias("a"), F.col("signature").alias("sa"), F.col("n").alias("na")), "a")
    held = held.join(classes.select(F.col("cid").alias("b"), F.col("signature").alias("sb"), F.col("n").alias("nb")), "b")
    held = held.where(F.least("na", "nb") >= THRESHOLD * F.greatest("na", "nb"))

    def run(rows):
        for batch in rows:
            n = batch.num_rows
            if not n:
                continue
            sides = [np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(c)).to_pylist()), "<u2").reshape(n, HASHES) for c in ("sa", "sb")]
            at = pa.array(survivors(*sides, np.arange(n), np.arange(n)))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)).take(at) for c in ("a", "b")], ["a", "b"])

    return held.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _block(part: pd.DataFrame) -> pd.DataFrame:
    """Links and a spanning forest of one block: all pairs of its one chunk, or of its two."""
    Memo.turn_to("ngrams")
    part = part.drop_duplicates("cid").sort_values("cid")
    out = {"cid": [], "other": [], "links": []}
    n = len(part)
    sigs = np.frombuffer(b"".join(part["signature"]), "<u2").reshape(n, HASHES)
    sizes, chunk, cids, copies = (part[c].to_numpy() for c in ("n", "chunk", "cid", "copies"))
    i, j = np.triu_indices(n, 1)
    if part["i"].iloc[0] != part["j"].iloc[0]:
        apart = chunk[i] != chunk[j]
        i, j = i[apart], j[apart]
    near = np.minimum(sizes[i], sizes[j]) >= THRESHOLD * np.maximum(sizes[i], sizes[j])
    i, j = i[near], j[near]
    alive = survivors(sigs, sigs, i, j)
    i, j = i[alive], j[alive]
    if not len(i):
        return pd.DataFrame(out).astype({"cid": "int64", "other": "Int64", "links": "int64"})
    used = np.unique(np.concatenate([i, j]))
    texts = part["text"].to_numpy()
    sets = {int(k): shingles(texts[k]) for k in used}
    both = _intersections(sets, i, j)
    linked = both >= THRESHOLD * (sizes[i] + sizes[j] - both) - 1e-9
    i, j = i[linked], j[linked]
    links = np.zeros(n, np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    for k in np.flatnonzero(links):
        out["cid"].append(int(cids[k]))
        out["other"].append(None)
        out["links"].append(int(links[k]))
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(i.tolist(), j.tolist()):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out["cid"].append(int(cids[x]))
            out["other"].append(int(cids[y]))
            out["links"].append(0)
    return pd.DataFrame(out).astype({"cid": "int64", "other": "Int64", "links": "int64"})


def _intersections(sets: dict[int, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the common parts of pairs of sets: one by one, or for many pairs as tiles of a matrix product."""
    if len(i) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i.tolist(), j.tolist())], np.int64)
    keys = sorted(sets)
    row = {k: r for r, k in enumerate(keys)}
    values, column = np.unique(np.concatenate([sets[k] for k in keys]), return_inverse=True)
    owner = np.repeat(np.arange(len(keys)), [len(sets[k]) for k in keys])
    by = np.argsort(column, kind="stable")
    column, owner = column[by], owner[by]
    total = np.zeros((len(keys), len(keys)))
    for a in range(0, len(values), 8192):
        lo, hi = np.searchsorted(column, [a, a + 8192])
        tile = np.zeros((len(keys), 8192), np.float32)
        tile[owner[lo:hi], column[lo:hi] - a] = 1
        total += tile @ tile.T
    at = lambda x: np.array([row[k] for k in x.tolist()])
    return total[at(i), at(j)].round().astype(np.int64)


def links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links) of every row."""
    rows, known = _joined(two_columns(df, id_col, text_col))
    whole = rows.select("doc_id", "set_key", "n").join(known, "set_key", "left")
    alone = F.col("n") == 0
    return whole.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, with all their columns, that are the first of their class by (id, text hash).

    Rows without shingles all stay; of rows that repeat id and text, any one does."""
    rows, known = _joined(two_columns(df, id_col, text_col))
    whole = rows.join(known.select("set_key", "component"), "set_key", "left")
    own, part, of, hashed = free_names(df, "_text_hash", "_component", "_id", "_hash")
    first = whole.where("n > 0").groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("k")).select(F.col("component").alias(part), F.col("k.doc_id").alias(of), F.col("k.text_hash").alias(hashed))
    first = cut_lineage(first, "first-of-class")
    held = df.withColumn(own, F.xxhash64(text_of(text_col)))
    empty = ~text_of(text_col).rlike(f"[^{SPACE[1:]}")  # only white space, as the sketch's split() has it
    stay = held.where(~empty).join(first, (held[own] == first[hashed]) & held[id_col].eqNullSafe(first[of]))
    if rows.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        stay = stay.select(*(held[c] for c in df.columns))
    else:
        stay = stay.dropDuplicates([part]).select(*df.columns)
    return stay.unionByName(held.where(empty).select(*df.columns))


def _joined(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, and of every set key: component, class_id, n_links."""
    rows = cut_lineage(_sketch(docs), "sketches")
    kinds = rows.where("n > 0").groupBy("set_key", "n", "signature").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    classes = cut_lineage(kinds.select(F.monotonically_increasing_id().alias("cid"), "*"), "shingle-classes")

    bands = _bands(classes)
    few = bands.where(F.col("n") <= SMALL_BAND).select("band", "cid")
    pairs = few.select("band", F.col("cid").alias("a")).join(few.select("band", F.col("cid").alias("b")), "band").where("a < b").select("a", "b").distinct()
    many = bands.where((F.col("n") > SMALL_BAND) & (F.col("cid") != F.col("lead"))).select(F.col("lead").alias("a"), F.col("cid").alias("b"))
    homes = cut_lineage(components(_pruned(pairs, classes).unionByName(many)), "neighbourhoods")

    chunks = homes.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("long").alias("chunks"))
    placed = homes.join(chunks, "component").withColumnRenamed("node", "cid")
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")))
    wanted = placed.join(classes, "cid").select("cid", "component", "chunks", "chunk", "n", "signature", "copies", F.col("first.doc_id").alias("one"), "first.text_hash")
    texts = docs.withColumn("text_hash", F.xxhash64("text"))
    held = texts.join(wanted, (texts["text_hash"] == wanted["text_hash"]) & texts["doc_id"].eqNullSafe(wanted["one"])).drop("doc_id", "one", "text_hash")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    dealt = held.withColumn("with", other).withColumns({"i": F.least("chunk", "with"), "j": F.greatest("chunk", "with")})
    found = dealt.select("component", "i", "j", "chunk", "cid", "n", "signature", "copies", "text").groupBy("component", "i", "j").applyInPandas(_block, "cid long, other long, links long")
    found = cut_lineage(found, "links")

    counts = found.where("other IS NULL").groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(found.where("other IS NOT NULL").select(F.col("cid").alias("a"), F.col("other").alias("b")))
    labelled = classes.select("cid", "set_key", "copies", "least_id").join(joined, F.col("cid") == F.col("node"), "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "cid"))
    names = labelled.groupBy("component").agg(F.min("least_id").alias("class_id"))
    known = labelled.join(names, "component").join(counts, "cid", "left")
    return rows, known.select("set_key", "component", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
