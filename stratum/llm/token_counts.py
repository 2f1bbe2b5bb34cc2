"""Token counts of every prefix of a text, kept so that truncation and budget questions need no encoding.

``prefix_counts`` stores, for each document, the change of the token count from one character to the
next (``deltas``; a prefix's count is the sum up to it; one signed integer of ``width`` bytes each).
Within a word the counts come from dynamic programming over positions (``bpe.Automaton``).  A
prefix may end where the whole text would not be split; those places are corrected:

* a run of white space that the prefix ends in is one word there, while in the text its last
  character belongs to what follows;
* a contraction that is cut after its first letter is two words;
* a special string that is cut is ordinary text.

One pass without a shuffle; only the tokenizer file is broadcast.  Null and empty texts have no
tokens and an empty table; ids may repeat; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import Codec, Memo, codec, read_spec
from .bpe_documents import _arrow
from .common import batches, two_columns

LIMIT = 1024
_CUT_TAILS = ("'re", "'ve", "'ll")
_WIDTHS = {1: np.int8, 2: np.int16, 4: np.int32}


class PrefixCounter:
    """Prefix counts of one byte-level tokenizer without an end-of-word suffix."""

    def __init__(self, c: Codec):
        if c.suffix:
            raise ValueError("prefixes of a word have no count under an end-of-word suffix")
        self.codec = c
        self.deltas = Memo(self._deltas)
        self.run = regex.compile(r"\p{White_Space}{2,}(?=\P{White_Space})").finditer

    def _deltas(self, chunk: str) -> bytes | None:
        """Count changes per character of a word or chunk, one signed byte each; None if one byte is too small."""
        c = self.codec
        words = [chunk] if c.odd(chunk) else c.words(chunk)
        if len(words) > 1:
            parts = [self.deltas[w] for w in words]
            return None if None in parts else b"".join(parts)
        d = self.changes(chunk)
        return bytes([x & 255 for x in d]) if -128 <= min(d) and max(d) < 128 else None

    def changes(self, word: str) -> list[int]:
        """Count changes per character of a word."""
        counts = self.codec.automaton.prefix_counts(self.codec.spell(word))
        if not word.isascii():
            at = 0
            ends = [at := at + len(x.encode("utf-8")) for x in word]
            counts = [0, *(counts[i] for i in ends)]
        if word in _CUT_TAILS:
            counts[2] = 2
        return [b - a for a, b in zip(counts, counts[1:])]

    def text(self, text: str) -> tuple[bytes, int, int]:
        """(deltas, width of one, token count) of a text."""
        parts = self.codec.parts(text)
        if any(isinstance(p, int) for p in parts):
            return self._with_specials(parts)
        d = self._ordinary(text)
        if isinstance(d, bytes):
            return d, 1, int(np.frombuffer(d, np.int8).sum(dtype=np.int64))
        return self._stored(d)

    def _stored(self, d: np.ndarray) -> tuple[bytes, int, int]:
        most = np.abs(d).max(initial=0)
        width = 1 if most < 1 << 7 else 2 if most < 1 << 15 else 4
        return d.astype(_WIDTHS[width]).tobytes(), width, int(d.sum())

    def _with_specials(self, parts: list[str | int]) -> tuple[bytes, int, int]:
        """Before each special string the text so far and the string's beginning count as ordinary text."""
        name = {n: s for s, n in self.codec.specials.items()}
        out, base = [0], 0
        for i, part in enumerate(parts):
            if isinstance(part, str):
                following = name[parts[i + 1]][:-1] if i + 1 < len(parts) else ""
                counts = np.cumsum(np.concatenate([[0], self._array(part + following)]))
                own = int(np.cumsum(np.concatenate([[0], self._array(part)]))[-1])
                out.extend((base + counts[1:]).tolist())
                base += own
                if following:
                    base += 1
                    out.append(base)
            elif i == 0 or not isinstance(parts[i - 1], str):
                special = name[part]
                out.extend((base + np.cumsum(self._array(special[:-1]))).tolist())
                base += 1
                out.append(base)
        return self._stored(np.diff(np.array(out, dtype=np.int64)))

    def _array(self, text: str) -> np.ndarray:
        d = self._ordinary(text)
        return np.frombuffer(d, np.int8).astype(np.int64) if isinstance(d, bytes) else d

    def _ordinary(self, text: str) -> bytes | np.ndarray:
        """Count changes of a text without special strings."""
        c = self.codec
        if not text:
            return b""
        parts = list(map(self.deltas.__getitem__, c.chunks(text)))
        plain = None not in parts
        if plain and not (c.odd(text) or c.other_space(text)):
            return b"".join(parts)
        if plain:
            d = np.frombuffer(b"".join(parts), np.int8).astype(np.int64)
        else:
            d = np.array([x for w in c.split(text) for x in self.changes(w)], dtype=np.int64)
        for m in self.run(text):  # a prefix that ends with the whole run has the run as one word
            a, b = m.span()
            run, before, last = (sum(self.changes(x)) for x in (text[a:b], text[a : b - 1], text[b - 1 : b]))
            d[b - 1] += run - before - last
            d[b] -= run - before - last
        return d


def prefix_counts(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_chars, n_tokens, width, deltas) of every row."""
    docs = two_columns(df, id_col, text_col)
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    kind = _arrow(docs)

    def run(rows):
        counter = _counter(spec.value)
        for ids, texts in batches(rows, "doc_id", "text"):
            got = [counter.text(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, kind),
                    pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                    pa.array(list(map(len, texts)), pa.int64()),
                    pa.array([g[2] for g in got], pa.int64()),
                    pa.array([g[1] for g in got], pa.int32()),
                    pa.array([g[0] for g in got], pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_chars", "n_tokens", "width", "deltas"],
            )

    long, whole = T.LongType(), T.IntegerType()
    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], *(T.StructField(n, t) for n, t in (("n_bytes", long), ("n_chars", long), ("n_tokens", long), ("width", whole), ("deltas", T.BinaryType())))]))


_COUNTERS: dict[int, PrefixCounter] = {}


def _counter(spec: str) -> PrefixCounter:
    Memo.turn_to("bpe")
    c = codec(spec)
    if id(c) not in _COUNTERS:
        _COUNTERS[id(c)] = PrefixCounter(c)
    return _COUNTERS[id(c)]


def counts_of(deltas: bytes, width: int) -> np.ndarray:
    """Counts of all prefixes, the empty one first."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(deltas, _WIDTHS[width]), dtype=np.int64)])


def _question(fn, kind):
    @F.pandas_udf(kind)
    def ask(deltas: pd.Series, width: pd.Series, number: pd.Series) -> pd.Series:
        return pd.Series([fn(counts_of(d, w), n) for d, w, n in zip(deltas, width, number)])

    return ask


def count_at(n_chars: Column) -> Column:
    """Tokens of the prefix of ``n_chars`` characters (of the whole text, if it is shorter)."""
    return _question(lambda counts, n: int(counts[min(max(int(n), 0), len(counts) - 1)]), "long")("deltas", "width", n_chars)


def longest_within(budget: Column) -> Column:
    """Characters of the longest prefix that has at most ``budget`` tokens (counts may fall as a prefix grows)."""
    return _question(lambda counts, n: int(np.flatnonzero(counts <= max(int(n), 0))[-1]), "long")("deltas", "width", budget)


def totals(df: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): the last entry of each document's table."""
    return prefix_counts(df, tokenizer_path).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
