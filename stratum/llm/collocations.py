"""Collocations per language by vertically partitioned suffix trees of the words, cut at a depth.

1. Texts are lower-cased (A to Z), cut into pieces at punctuation and line ends, pieces into words.
   Every word starts a suffix: it and the next ``depth - 1`` words of its piece.  Equal suffixes of a
   batch are counted where the text is read.
2. Vertical partitioning: first words fall into classes by hash, as many as keep a class near
   ``GROUP_ROWS`` counted suffixes (``FAN`` at most).  A batch's suffixes of one class travel as one block, its words
   once and the suffixes as numbers, so a shuffled row is a block and not a suffix.  A class that
   exceeds the budget (a frequent word, or more text than a round of classes holds) is split again by two-word prefixes, and
   so on; a prefix as long as the depth is a leaf, whose total needs no tree.  So a word that holds a
   third of all words is spread over its continuations, and a task's memory is the budget's,
   whatever the size of the corpus.
3. Each class builds its subtrees on its own: suffixes sorted by word codes, the runs of equal first
   words are the nodes of a depth, and a node's frequency is the total of the leaves below it.  Nodes
   above the classes that were split are totals of the same blocks.
4. Nodes of two words or more are candidates; each cut's parts are looked up among the nodes
   (``lookup_join``: by size broadcast or shuffled, hot parts split by AQE), the lowest cut counts.
   The longest frequent phrase around a candidate is a maximum over the sub-phrases of longer ones,
   combined before the shuffle.  The report ranks by buckets first, then a language's bucket leaders.

A null text is empty, a null language is ``und``; repeated rows count each; texts of any length are
read whole, in stretches; an empty table gives no rows.  Other columns are not read.  Scores are exact
while 1,000,000 * a * a stays below 10**38.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.joins import lookup_join
from stratum.session import cut_lineage

from .common import batches, text_of

DEPTH = 3
LEAST = 10
#: Share (in hundredths) of a candidate's occurrences that lie in one longer phrase, from which it goes.
INSIDE = 50
TOP = 2000
#: Counted suffixes that a class of prefixes has about; above four times as many it is split by one more word.
GROUP_ROWS = 250_000
#: Most classes of one round: a batch is cut into as many blocks.
FAN = 2048
#: Bytes of text whose words are held as single objects at once.
STRETCH = 1 << 22
RANK_BUCKETS = 64

#: Punctuation and line ends become line feeds, tabs become spaces (the text is lower-cased before).
_MARKS = bytes(10 if chr(i) in ".,;:!?" or 10 <= i <= 13 else 32 if i == 9 else i for i in range(256))


def _words(depth: int) -> list[str]:
    return [f"w{i}" for i in range(1, depth + 1)]


def _codes(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """Word codes of the texts one after another, -1 where a piece ends, and the words."""

    def stretches() -> Iterator[pa.Array]:
        for text in _joined(texts):
            at = 0
            while at < len(text):
                to = text.find(b" ", at + STRETCH)
                to = len(text) if to < 0 else to
                yield pa.array(text[at:to].split(b" "), pa.binary())
                at = to + 1

    parts = list(stretches())
    if not parts:
        return np.empty(0, np.int64), pa.array([], pa.binary())
    coded = pa.concat_arrays(parts).dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy().copy()
    empty, end = (pc.index(words, pa.scalar(x, pa.binary())).as_py() for x in (b"", b"\n"))
    codes = codes[codes != empty]
    codes[codes == end] = -1
    return codes, words


def _joined(texts: list[bytes]) -> Iterator[bytes]:
    """Texts of a piece end between any two, long ones by themselves."""
    held, size = [], 0
    for t in texts:
        held.append(t.lower().translate(_MARKS).replace(b"\n", b" \n "))
        size += len(t)
        if size >= STRETCH:
            yield b" \n ".join(held) + b" \n"
            held, size = [], 0
    if held:
        yield b" \n ".join(held) + b" \n"


def _runs(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Columns (of -1 and up) and counts in the order of the columns, and whether a row differs from the one before, per depth."""
    span = [int(c.max(initial=-1)) + 2 for c in columns]
    if math.prod(span) < 1 << 62:
        key = np.zeros(len(counts), np.int64)
        for c, n in zip(columns, span):
            key *= n
            key += c
            key += 1
        order = np.argsort(key)
        del key
    else:
        order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    differs = np.zeros((len(columns), len(order)), bool)
    differs[:, :1] = True
    for d, c in enumerate(columns):
        differs[d, 1:] = c[1:] != c[:-1]
    return columns, counts[order], np.logical_or.accumulate(differs)


def _combined(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows as one, with the sum of their counts."""
    columns, counts, differs = _runs(columns, counts)
    first = np.flatnonzero(differs[-1])
    return [c[first] for c in columns], np.add.reduceat(counts, first)


def _packed(words: pa.Array, columns: list[np.ndarray], counts: np.ndarray, seen: np.ndarray, room: np.ndarray) -> bytes:
    """A block: its distinct words, the suffixes as numbers of them (0: none), the counts.

    ``seen`` and ``room`` are arrays of zeros, as long as there are words and one more; they are given back as such."""
    for c in columns:
        seen[c] = True
    seen[-1] = False  # no word
    used = np.flatnonzero(seen)
    seen[used], room[used] = False, np.arange(1, len(used) + 1)
    kinds = ["<u2" if len(used) < 1 << 16 else "<u4", "<u1" if counts.max() < 1 << 8 else "<u8"]
    code = np.stack([room[c].astype(kinds[0]) for c in columns])
    room[used] = 0
    taken = words.take(pa.array(used))
    ends = np.frombuffer(taken.buffers()[1], np.int32, len(used) + 1, taken.offset * 4)
    text = taken.buffers()[2].to_pybytes()[ends[0] : ends[-1]]
    head = struct.pack("<IIIBB", len(counts), len(used), len(text), *(int(k[2]) for k in kinds))
    return zlib.compress(b"".join((head, np.diff(ends).astype("<u4").tobytes(), text, code.tobytes(), counts.astype(kinds[1]).tobytes())), 1)


def _unpacked(block: bytes, depth: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words, numbers (depth x n) and counts of a block."""
    block = zlib.decompress(block)
    n, known, size, wide, tall = struct.unpack_from("<IIIBB", block)
    at = 14 + 4 * known
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(block, "<u4", known, 14))]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), known, [None, pa.py_buffer(ends), pa.py_buffer(block[at : at + size])])
    at += size
    code = np.frombuffer(block, f"<u{wide}", n * depth, at).reshape(depth, n)
    return words, code, np.frombuffer(block, f"<u{tall}", n, at + n * depth * wide)


def _gathered(table: pa.Table, depth: int) -> tuple[list[str], pa.Array, list[np.ndarray], np.ndarray]:
    """Languages, words, columns (language and words) and counts of many blocks in one numbering."""
    langs = pc.dictionary_encode(table.column("lang").combine_chunks())
    held, codes, counts, sizes, base = [], [], [], [], 0
    for block in table.column("block").to_pylist():
        words, code, count = _unpacked(block, depth)
        code = code.astype(np.int32)
        code[code > 0] += base
        base += len(words)
        held.append(words)
        codes.append(code)
        counts.append(count)
        sizes.append(len(count))
    coded = pa.concat_arrays(held).dictionary_encode()
    number = np.concatenate([[-1], coded.indices.to_numpy()]).astype(np.int32)
    columns = [np.repeat(langs.indices.to_numpy(), sizes), *number[np.concatenate(codes, axis=1)]]
    return langs.dictionary.to_pylist(), coded.dictionary, columns, np.concatenate(counts).astype(np.int64)


def _hashes(lang: str, words: pa.Array) -> np.ndarray:
    """A 32-bit number of each word of a language."""
    seed = zlib.crc32(lang.encode())
    return np.fromiter((zlib.crc32(w, seed) for w in words.to_pylist()), np.uint64, len(words))


def _blocks_of(lang: str, words: pa.Array, columns: list[np.ndarray], counts: np.ndarray, prefix: int, classes: int, above: int = 0) -> Iterator[tuple]:
    """(lang, part, n, total, block) per class of the suffixes' first ``prefix`` words; ``above`` is the class that is split."""
    columns, counts = _combined(columns, counts)
    hashes, mixed = np.append(_hashes(lang, words), np.uint64(0)), np.zeros(len(counts), np.uint64)  # the last: no word
    for c in columns[:prefix]:
        mixed = (mixed ^ hashes[c]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    part = (mixed % np.uint64(classes)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    bounds = np.flatnonzero(np.diff(part[order], prepend=-1, append=classes))
    seen, room = np.zeros(len(words) + 1, bool), np.zeros(len(words) + 1, np.int32)
    for a, b in zip(bounds, bounds[1:]):
        at = order[a:b]
        yield lang, above * classes + int(part[at[0]]), len(at), int(counts[at].sum()), _packed(words, [c[at] for c in columns], counts[at], seen, room)


_BLOCK = T.StructType([T.StructField("lang", T.StringType())]).add("part", "long").add("n", "long").add("total", "long").add("block", "binary")


def _block_columns(rows: list[tuple]) -> tuple[list[pa.Array], list[str]]:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    cols = list(zip(*rows)) if rows else [()] * 5
    return [pa.array(c, k) for c, k in zip(cols, kinds)], _BLOCK.names


def suffixes(docs: DataFrame, depth: int = DEPTH, classes: int = FAN, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, part, n, total, block): the counted suffixes of every text in blocks by their first word's class.

    ``n`` is how many different ones a block holds, ``total`` how many occurrences."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), body.alias("text"))

    def blocks(lang: str, held: list[bytes]) -> Iterator[tuple]:
        codes, words = _codes(held)
        starts = np.flatnonzero(codes >= 0)
        if len(starts):
            after = np.concatenate([codes, np.full(depth, -1, codes.dtype)])
            cols = [after[starts]]
            for d in range(1, depth):
                cols.append(np.where(cols[-1] >= 0, after[starts + d], codes.dtype.type(-1)))
            yield from _blocks_of(lang, words, cols, np.ones(len(starts), np.int64), 1, classes)

    def run(arrow):
        by, size = {}, 0
        for langs, texts in batches(arrow, "lang", "text"):
            for lang, text in zip(langs, texts):
                by.setdefault(lang, []).append(text)
                size += len(text)
            if size >= 2 * STRETCH:
                yield pa.RecordBatch.from_arrays(*_block_columns([b for lang, held in by.items() for b in blocks(lang, held)]))
                by, size = {}, 0
        yield pa.RecordBatch.from_arrays(*_block_columns([b for lang, held in by.items() for b in blocks(lang, held)]))

    return rows.mapInArrow(run, _BLOCK)


def _split(depth: int, prefix: int, classes: int):
    """Blocks of one class dealt to classes of longer prefixes."""

    def run(table: pa.Table) -> pa.Table:
        langs, words, columns, counts = _gathered(table, depth)
        above, out = table.column("part")[0].as_py(), []
        for i, lang in enumerate(langs):
            own = columns[0] == i
            out.extend(_blocks_of(lang, words, [c[own] for c in columns[1:]], counts[own], prefix, classes, above))
        return pa.table(*_block_columns(out))

    return run


def _subtrees(least: int, depth: int, length: int):
    """A class's nodes of ``length`` words or more and frequency ``least`` or more."""

    def run(table: pa.Table) -> pa.Table:
        langs, words, columns, counts = _gathered(table, depth)
        columns, counts, differs = _runs(columns, counts)
        out = []
        for d in range(length, depth + 1):
            first = np.flatnonzero(differs[d])
            total = np.add.reduceat(counts, first)
            keep = (total >= least) & (columns[d][first] >= 0)
            out.append(_node_table(langs, words, [c[first[keep]] for c in columns[: d + 1]], total[keep], depth))
        return pa.concat_tables(out)

    return run


def _node_table(langs: list[str], words: pa.Array, columns: list[np.ndarray], total: np.ndarray, depth: int) -> pa.Table:
    taken = [pa.array(langs, pa.string()).take(pa.array(columns[0])), *(words.take(pa.array(c)) for c in columns[1:])]
    taken += [pa.nulls(len(total), pa.binary())] * (depth + 1 - len(columns))
    return pa.table([*taken, pa.array(total, pa.int64())], ["lang", *_words(depth), "f"])


def nodes(counted: DataFrame, least: int = LEAST, depth: int = DEPTH, group_rows: int = GROUP_ROWS, classes: int = FAN) -> DataFrame:
    """(lang, w1..w<depth>, f): every phrase of up to ``depth`` words with frequency ``least`` or more.

    ``counted`` is a written table of ``suffixes``; words beyond the phrase are null."""
    names = _words(depth)
    schema = T.StructType([T.StructField("lang", T.StringType()), *(T.StructField(n, T.BinaryType()) for n in names), T.StructField("f", T.LongType())])
    rest, found = counted, []
    for length in range(1, depth):
        load = rest.groupBy("part").agg(F.sum("n").alias("load")).where(F.col("load") > 4 * group_rows)
        heavy = cut_lineage(load, "heavy-classes")  # at most suffixes / (4 * group_rows) numbers
        light = rest.join(F.broadcast(heavy), "part", "left_anti")
        found.append(light.groupBy("part").applyInArrow(_subtrees(least, depth, length), schema))
        if heavy.isEmpty():
            return _named(found, names)
        held = rest.join(F.broadcast(heavy), "part")
        found.append(_totals(held, least, depth, length))
        share = F.pmod(F.xxhash64("block"), F.ceil(F.col("load") / group_rows)).alias("share")
        longer = held.select("lang", "part", "n", "total", "block", share).groupBy("part", "share").applyInArrow(_split(depth, length + 1, classes), _BLOCK)
        rest = cut_lineage(longer, "longer-suffixes")
    found.append(_totals(rest, least, depth, depth))
    return _named(found, names)


def _totals(blocks: DataFrame, least: int, depth: int, length: int) -> DataFrame:
    """The nodes of exactly ``length`` words of some blocks, summed block by block first."""
    names = _words(depth)
    schema = T.StructType([T.StructField("lang", T.StringType()), *(T.StructField(n, T.BinaryType()) for n in names), T.StructField("f", T.LongType())])

    def run(arrow):
        for batch in arrow:
            for i in range(batch.num_rows):
                langs, words, columns, counts = _gathered(pa.Table.from_batches([batch.slice(i, 1)]), depth)
                columns, counts = _combined([c[columns[length] >= 0] for c in columns[: length + 1]], counts[columns[length] >= 0])
                yield from _node_table(langs, words, columns, counts, depth).to_batches()

    each = blocks.select("lang", "block").mapInArrow(run, schema)
    return each.groupBy("lang", *names).agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _named(frames: list[DataFrame], names: list[str]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select("lang", *(F.col(n).cast("string").alias(n) for n in names), "f")


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(19,0)")


def score(tree: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(lang, phrase, words, a, k, l, r, score) of every candidate: its lowest cut, and of equal ones the first."""
    listed = tree.select("lang", F.array_compact(F.array(*_words(depth))).alias("words"), "f").withColumn("phrase", _phrase(F.col("words")))
    listed = cut_lineage(listed, "phrases")
    known = listed.select("lang", "phrase", "f")
    cuts = listed.where(F.size("words") > 1).select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumn("first", _phrase(F.slice("words", 1, F.col("k")))).withColumn("last", _phrase(F.slice("words", F.col("k") + 1, F.size("words"))))
    cuts = lookup_join(cuts, known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = lookup_join(cuts, known.select("lang", F.col("phrase").alias("last"), F.col("f").alias("r")), ["lang", "last"])
    wide = "CAST({} AS DECIMAL(19,0))".format
    value = F.expr(f"({wide('a')} * {wide('a')} * CAST(1000000 AS DECIMAL(7,0))) DIV ({wide('l')} * {wide('r')})")
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(value.alias("score"), "k", "l", "r", "a", "words")).alias("best"))
    return lowest.select("lang", "phrase", "best.words", "best.a", "best.k", "best.l", "best.r", "best.score")


def without_parts(candidates: DataFrame, inside: int = INSIDE) -> DataFrame:
    """``candidates`` less those with ``inside`` hundredths of their occurrences in one longer candidate."""
    size, width = F.size("words"), F.col("width")
    longer = candidates.where(size > 2).select("lang", "words", "a").withColumn("width", F.explode(F.sequence(F.lit(2), size - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), size - width + 1)))
    around = longer.select("lang", _phrase(F.slice("words", F.col("at"), width)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    held = candidates.join(around, ["lang", "phrase"], "left")
    return held.where(F.coalesce(100 * _exact("most") < inside * _exact("a"), F.lit(True))).drop("most")


def collocations(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, inside: int = INSIDE, top: int = TOP, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Rank 1 has the highest score; ties go by frequency, then by the phrase's bytes."""
    words = docs.select(F.sum(F.octet_length(text_of("text"))).alias("n")).first()["n"] or 0  # a word and its space are six bytes or so
    classes = min(FAN, max(1, -(-words // (6 * group_rows))))
    counted = cut_lineage(suffixes(docs, depth, classes), "suffixes")
    scored = cut_lineage(score(nodes(counted, least, depth, group_rows, max(classes, 16)), depth), "candidates")
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    left = without_parts(scored, inside).withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(RANK_BUCKETS)))
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))).where(F.col("rank") <= top)
    best = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    sizes = counted.groupBy("lang").agg(F.sum("total").alias("n"))
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
