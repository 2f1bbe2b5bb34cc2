"""Toxicity scores of texts whose words may be disguised: noisy-channel restoring, then scoring.

``language_model`` counts character trigrams of all documents' words (counts, no word list, leave
Spark: the table is bounded by the alphabet).  ``Restorer`` turns a token into a lattice of readings:
each character may stand for itself, for a letter it looks like, for nothing (a separator or filler),
and a run of one character for one or two of it; spaced letters form one lattice whose spaces may
vanish.  Viterbi finds the reading that is likeliest under the model times the channel.

``lexicon`` learns which restored words and word beginnings mark toxic documents: in how many
documents of either class each occurs.  ``weights`` fits a logistic function of a document's few
strongest words and its size, each labelled document seen without its own counts.  ``score`` applies
both to every restored text.  Labels are used to learn only; a score depends on the text alone.

Null and empty texts have the score of a text without evidence; ids may repeat, each row is scored.
Labels of null toxicity or of ids without a document teach nothing; an id with several labels counts
each.  Without labels of both classes every score is 0.  Other columns are not read.  Corpus and label
statistics shuffle as (trigram or word, counts) after map-side sums; scoring has no shuffle.  What is
broadcast is the trigram table (rare letters count as one, so at most ``ALPHABET`` + 2 cubed, in truth
far less) and the lexicon (words and beginnings of the labelled sample whose root speaks for toxicity, about ``LEXICON``).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import cut_lineage

from .bpe import Memo
from .bpe_documents import _arrow
from .common import batches, slices, two_columns

THRESHOLD = 0.3
#: Letters the model knows beyond a to z: the most frequent of the corpus, up to so many in all.
ALPHABET = 96
#: The letter that stands for all others in the model.
OTHER = "\uffff"
#: Entries of the lexicon above which the evidence that its roots need is raised, in steps of 0.01: a bound of
#: the classifier, like FIT_ROWS (30,000 labelled rows of the largest table tried hold 698,000 entries).
LEXICON = 50_000
#: Log odds against the base rate that the strongest entry of a root needs.
MARGIN = math.log(2)
#: Word beginnings of these lengths are evidence besides whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Documents' worth of a shorter beginning's rate in that of a longer one.
SHRINK = 3.0
#: Words of a document that its score rests on, and the ridge of the last step.
STRONGEST = 4
RIDGE = 1.0
#: Words whose trigrams are counted at once.
COUNT_WORDS = 50_000
#: Labelled rows to learn from: a sample by hash, of all if there are no more.
FIT_ROWS = 30_000
# What a character may stand for besides itself.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¥": "y", "#": "h",
}
#: Characters that may be fillers between letters.
FILLERS = " .,-_*~'`\"^:;/\\|!?#%&$+=()[]{}<>"
#: Log costs of the channel: a lookalike, a filler left out, one taken away from a run, a digit or symbol left as it is.
SWAP, DROP, RUN, STAY = -1.0, -0.7, -0.3, -6.0
#: Log costs of a space between spaced letters: a word ends there, or it vanishes.
BREAK, JOIN = -1.5, -0.2
EDGE = " "


class Model:
    """Character trigrams of words with interpolated counts; a word is framed by EDGE."""

    def __init__(self, counts: dict[str, int]):
        self.three = Counter(counts)
        self.two, self.one, self.letters = Counter(), Counter(), Counter()
        for g, n in counts.items():
            self.two[g[:2]] += n
            self.one[g[1]] += n
            self.letters[g[1:]] += n
        self.total = sum(self.one.values())
        self.kept: dict[str, float] = {}

    def folded(self, text: str) -> str:
        """A text with OTHER for letters that the model doesn't tell apart."""
        return "".join(c if c in self.one or not c.isalpha() else OTHER for c in text)

    def known(self, word: str) -> bool:
        """Whether all trigrams of a word were counted."""
        framed = EDGE + EDGE + self.folded(word) + EDGE
        return all(framed[i - 2 : i + 1] in self.three for i in range(2, len(framed)))

    def log(self, before: str, char: str) -> float:
        """Log probability of a character after two others."""
        key = before + char
        got = self.kept.get(key)
        if got is None:
            if len(self.kept) >= 200_000:
                self.kept.clear()
            raw, key = key, self.folded(key)
            before, char = key[:2], key[2]
            n3, n2 = self.three.get(key, 0), self.two.get(before, 0)
            m2, m1 = self.letters.get(key[1:], 0), self.one.get(before[1], 0)
            p1 = (self.one.get(char, 0) + 0.1) / (self.total + 10)
            p2 = (m2 + 2 * p1) / (m1 + 2)
            got = self.kept[raw] = math.log((n3 + 3 * p2) / (n2 + 3))
        return got


class Restorer:
    """Viterbi over the lattice of a disguised word."""

    plain = re.compile(r"[^\W\d_]+").fullmatch
    run = re.compile(r"(.)\1").search
    pairs = re.compile(r"(.)\1")
    tangled = re.compile(r"(.)\1\1|(.)\2(.)\3").search  # three in a row, or two pairs side by side
    # Fillers that end a token: no letter, so none is likelier than the word's end, and leaving one out costs less than it does.
    dropped = re.compile("[" + re.escape("".join(c for c in FILLERS if c not in LOOKALIKES and c != EDGE)) + "]+").fullmatch
    trim = re.compile(r"^[\W_]+|[\W_]+$").sub
    spaced = re.compile(r"(?<!\S)[^\s.\-_*](?:[ .\-_*]{1,3}[^\s.\-_*]){2,}(?!\S)")  # no separator is a letter: one parse a run

    def __init__(self, model: Model):
        self.model = model
        self.word = Memo(self.decoded, 50_000, "toxicity").__getitem__

    def decoded(self, token: str) -> str:
        """A token's likeliest reading, in lower case; a token of letters none of which is doubled has only one.

        A number is read as letters where the corpus has all trigrams of the reading, else it stays."""
        low = token.lower()
        if self.plain(low):
            if not self.run(low):
                return low
            if not self.tangled(low):
                return self.pairs.sub(self.pair, low)
        core = self.trim("", low)
        if not core:
            return core
        if core.isdigit():
            read = self.viterbi(core)
            return read if self.model.known(read) else core
        if self.plain(core) and not any(c in LOOKALIKES for c in low):
            if not self.run(core):
                return core
            if self.dropped(low, len(core)) and low.startswith(core) and not self.tangled(core):
                return self.pairs.sub(self.pair, core)
        return self.viterbi(low)

    def pair(self, m: re.Match) -> str:
        """One or two letters for a doubled one between single ones.

        Both readings reach the same state one letter further on, so the lattice's choice is that of
        the arcs up to there: the rest of the word costs both the same."""
        c, i, word = m.group(1), m.start(), m.string
        last, then, log = word[i - 1] if i else EDGE, word[m.end()] if m.end() < len(word) else EDGE, self.model.log
        cost = self.readings(c)[0][1]
        one, two = cost + RUN + log(last + c, then), 2 * cost + log(last + c, c) + log(c + c, then)
        return c if one >= two else c + c

    def letters(self, spread: str) -> list[str]:
        """The words that spaced letters spell."""
        return self.viterbi(spread.lower()).split()

    def readings(self, char: str) -> list[tuple[str, float]]:
        """(what a character may stand for, cost)."""
        if char.isspace():
            return [(EDGE, BREAK), ("", JOIN)]
        out = [(char, 0.0 if char.isalpha() else STAY)]
        out += [(c, SWAP) for c in LOOKALIKES.get(char, "")]
        if char in FILLERS:
            out.append(("", DROP))
        return out

    def arcs(self, char: str, n: int) -> list[tuple[str, float]]:
        """Readings of a run of ``n`` equal characters: as nothing, as one or as two of a reading."""
        out = []
        for c, cost in self.readings(char):
            if not c or c == EDGE:
                out.append((c, cost * (min(n, 3) if char != EDGE else 1)))
                continue
            out.append((c, cost + RUN * min(n - 1, 3)))
            if n > 1:
                out.append((c + c, cost * 2 + RUN * min(n - 2, 3)))
        return out

    def viterbi(self, token: str) -> str:
        """The likeliest reading: states are the last two letters, a step takes a run of one character."""
        log = self.model.log
        states: dict[str, tuple[float, tuple]] = {EDGE + EDGE: (0.0, ())}
        i = 0
        while i < len(token):
            j = i + 1
            while j < len(token) and token[j] == token[i]:
                j += 1
            arcs, after = self.arcs(token[i], j - i), {}
            for last, (score, path) in states.items():
                for letters, cost in arcs:
                    s, two = score + cost, last
                    for c in letters:
                        s += log(two, c)
                        two = two[1] + c if c != EDGE else EDGE + EDGE
                    if two not in after or s > after[two][0]:
                        after[two] = (s, (path, letters) if letters else path)
            states, i = after, j
        _, path = max(((s + log(two, EDGE), p) for two, (s, p) in states.items()), key=lambda x: x[0])
        out = []
        while path:
            path, letters = path
            out.append(letters)
        return "".join(reversed(out)).strip()

    def tokens(self, text: str) -> set[str]:
        """The distinct restored words of a text."""
        out = set(map(self.word, set(text.split())))
        for m in self.spaced.finditer(text):
            out.update(self.letters(m.group()))
        out.discard("")
        return out

    def text(self, text: str) -> str:
        """The restored text, words apart by one space."""
        joined = self.spaced.sub(lambda m: " ".join(self.letters(m.group())), text)
        return " ".join(filter(None, map(self.word, joined.split())))


def restored(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with every text restored under the model of all of them."""
    docs = two_columns(df, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(language_model(docs).three)
    kind = _arrow(docs)

    def run(rows):
        Memo.turn_to("toxicity")
        r = _restorer(shared)
        for ids, texts in batches(rows, "doc_id", "text"):
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(map(r.text, texts), pa.string())], ["doc_id", "text"])

    return docs.mapInArrow(run, docs.schema)


def features(word: str) -> list[str]:
    """A word's beginnings, shortest first and marked by a star, and the word itself."""
    return [word[:n] + "*" for n in BEGINNINGS if len(word) >= n] + [word]


class Evidence:
    """How much a word speaks for toxicity: log odds of its documents' toxic rate against the base rate.

    The rate of a longer beginning is shrunk towards that of the next shorter one, so a word that was
    never seen has the evidence of what it begins with."""

    def __init__(self, counts: dict[str, tuple[int, int]], base: float):
        self.counts, self.base = counts, base
        self.roots = {f[: BEGINNINGS[0]] for f in counts}  # all features of a word begin like it

    def word(self, word: str, own: int | None = None) -> float:
        """Log odds; ``own``, the label of a document that was counted, takes it out again."""
        if word[: BEGINNINGS[0]] not in self.roots:
            return 0.0
        rate, known = self.base, False
        for f in features(word):
            got = self.counts.get(f)
            if got is not None:
                clean, toxic = got
                if own is not None:
                    clean, toxic = max(clean - (own == 0), 0), max(toxic - (own == 1), 0)
                rate, known = (toxic + SHRINK * rate) / (clean + toxic + SHRINK), True
        return math.log(rate * (1 - self.base) / ((1 - rate) * self.base)) if known else 0.0


def summary(found: list[float], n_words: int) -> list[float]:
    """What the last step sees of a document: its strongest words and, if there is any, among how many."""
    top = sorted([x for x in found if x > 0], reverse=True)[:STRONGEST]
    return [*top, *[0.0] * (STRONGEST - len(top)), math.log1p(n_words) if top else 0.0]


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def trigrams(words: dict[str, int]) -> Counter:
    """How often each trigram of letters occurs in words that occur so often, as arrays of so many words at once."""
    clean, parts, times = re.compile(r"[^\W\d_]+").findall, [], []
    for w, n in words.items():
        w = w.lower()
        found = (w,) if w.isalpha() else clean(w)
        parts += found
        times += [n] * len(found)
    grams: Counter = Counter()
    for at in range(0, len(parts), COUNT_WORDS):
        some = parts[at : at + COUNT_WORDS]
        framed = "".join([EDGE + EDGE + part + EDGE for part in some])
        codes = np.frombuffer(framed.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sizes = np.array([len(part) + 3 for part in some])
        whole = np.ones(len(codes), bool)  # no trigram starts at a word's last two characters
        ends = np.cumsum(sizes)
        whole[ends - 1] = whole[ends - 2] = False
        keys = (codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[whole[:-2]]
        counted = pa.table([pa.array(keys), pa.array(np.repeat(np.array(times[at : at + COUNT_WORDS], np.int64), sizes - 2))], ["gram", "n"])
        counted = counted.group_by("gram", use_threads=False).aggregate([("n", "sum")])
        for key, n in zip(counted["gram"].to_pylist(), counted["n_sum"].to_pylist()):
            grams[chr(key >> 42) + chr(key >> 21 & 0x1FFFFF) + chr(key & 0x1FFFFF)] += n
    return grams


def language_model(docs: DataFrame) -> Model:
    """Trigrams of the lower-case letters of all whole texts, counted as data."""

    def run(rows):
        Memo.turn_to("toxicity")
        words: Counter = Counter()
        for (texts,) in batches(rows, "text"):
            for t in texts:
                words.update(t.split())
            if len(words) > 150_000:
                yield count(words)
                words.clear()
        yield count(words)

    def count(words: Counter) -> pa.RecordBatch:
        grams = trigrams(words)
        return pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], ["gram", "n"])

    grams = docs.select("text").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    grams = cut_lineage(grams, "trigrams")
    latin = "abcdefghijklmnopqrstuvwxyz"
    letter = F.substring("gram", 2, 1)  # each letter of a word is the middle of one trigram
    others = grams.where(letter != EDGE).where(~letter.isin(*latin)).groupBy(letter.alias("c")).agg(F.sum("n").alias("n"))
    told = latin + "".join(r["c"] for r in others.orderBy(F.desc("n"), "c").limit(ALPHABET - len(latin)).collect())
    folded = grams.groupBy(F.regexp_replace("gram", f"[^{EDGE}{told}]", OTHER).alias("gram")).agg(F.sum("n").alias("n"))
    return Model({r["gram"]: r["n"] for r in folded.collect()})


def labelled_words(labelled: DataFrame, model: Model) -> DataFrame:
    """(toxic, words) of rows (toxic, text): the distinct restored words, written; both fits read them."""
    shared = labelled.sparkSession.sparkContext.broadcast(model.three)

    def run(rows):
        Memo.turn_to("toxicity")
        r = _restorer(shared)
        for toxic, texts in batches(rows, "toxic", "text"):
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array([sorted(r.tokens(t)) for t in texts], pa.list_(pa.string()))], ["toxic", "words"])

    return cut_lineage(labelled.select("toxic", "text").mapInArrow(run, "toxic int, words array<string>"), "labelled-words")


def _word_lists(rows) -> Iterator[tuple[list[int], list[list[str]]]]:
    for batch in rows:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            yield part.column("toxic").to_pylist(), part.column("words").to_pylist()


def lexicon(known: DataFrame) -> Evidence | None:
    """Evidence of words and beginnings from rows (toxic, words); None without both classes.

    It holds words of the labelled sample alone, whole roots, those of most evidence first, about ``LEXICON`` entries."""

    def run(rows):
        for toxic, found in _word_lists(rows):
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for y, words in zip(toxic, found):
                seen[y].update({f for w in words for f in features(w)})
                seen[y][""] += 1
            words = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([s[w] for w in words], pa.int64()) for s in seen)], ["word", "clean", "toxic"])

    counted = known.mapInArrow(run, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counted = cut_lineage(counted.where("clean + toxic > 1 OR word = ''"), "toxic-words")
    whole = counted.where("word = ''").first()
    if whole is None or not whole["clean"] or not whole["toxic"]:
        return None
    base = whole["toxic"] / (whole["toxic"] + whole["clean"])
    entries = counted.where("word != ''").withColumn("root", F.substring(F.regexp_replace("word", r"\*$", ""), 1, BEGINNINGS[0]))
    rate = (F.col("toxic") + SHRINK * F.lit(base)) / (F.col("clean") + F.col("toxic") + SHRINK)
    marked = entries.where("toxic > 1").groupBy("root").agg(F.max(F.log(rate * (1 - base) / ((1 - rate) * base))).alias("most")).where(F.col("most") >= MARGIN)
    marked = cut_lineage(marked.join(entries.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "root"), "toxic-roots")
    step = F.floor(F.col("most") * 100)
    total, least = 0, None
    for r in marked.groupBy(step.alias("step")).agg(F.sum("n").alias("n")).orderBy(F.desc("step")).collect():
        total += r["n"]
        if least is not None and total > LEXICON:
            break
        least = r["step"]
    rows = entries.join(marked.where(step >= F.lit(least)).select("root"), "root").collect()
    return Evidence({r["word"]: (r["clean"], r["toxic"]) for r in rows}, base)


def weights(known: DataFrame, evidence: Evidence) -> list[float]:
    """Logistic weights of ``summary`` and a constant, on labelled rows (toxic, words) less their own counts."""
    shared = known.sparkSession.sparkContext.broadcast(evidence)

    def run(rows):
        for toxic, found in _word_lists(rows):
            out = [[float(y), *summary([shared.value.word(w, y) for w in words], len(words))] for y, words in zip(toxic, found)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.float64()))], ["x"])

    rows = known.mapInArrow(run, "x array<double>").collect()  # at most FIT_ROWS short rows
    data = np.array(sorted(r["x"] for r in rows))
    y, x = data[:, 0], np.concatenate([data[:, 1:], np.ones((len(data), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - RIDGE * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)), slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


_RESTORERS: dict[int, Restorer] = {}


def _restorer(shared) -> Restorer:
    counts = shared.value
    if id(counts) not in _RESTORERS:
        _RESTORERS.clear()
        _RESTORERS[id(counts)] = Restorer(Model(counts))
    return _RESTORERS[id(counts)]


def judge(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS):
    """A function from texts to scores, learned from (doc_id, text) and labels; it may be sent to tasks."""
    model = language_model(docs)
    marks = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    marks = marks.join(docs.select("doc_id"), "doc_id", "left_semi")  # only labels of documents take places in the sample
    marks = marks.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(fit_rows)  # bounded, so it may be broadcast
    labelled = cut_lineage(docs.join(F.broadcast(marks), "doc_id").select("toxic", "text"), "labelled")
    known = labelled_words(labelled, model)
    evidence = lexicon(known)
    if evidence is None:
        return lambda texts: [0.0] * len(texts)
    sc = docs.sparkSession.sparkContext
    shared, learned = sc.broadcast(model.three), sc.broadcast((evidence, weights(known, evidence)))

    def scores(texts: list[str]) -> list[float]:
        Memo.turn_to("toxicity")
        r, (found, w) = _restorer(shared), learned.value
        read, out = _readings(r, found), []
        for t in texts:
            words = dict(map(read.__getitem__, set(t.split())))  # each restored word once, as in fitting
            for m in r.spaced.finditer(t):
                words.update((x, found.word(x)) for x in r.letters(m.group()))
            words.pop("", None)
            z = sum(a * b for a, b in zip([*summary(list(words.values()), len(words)), 1.0], w))
            out.append(1 / (1 + math.exp(-max(min(z, 30.0), -30.0))))
        return out

    return scores


_READINGS: dict[tuple[int, int], Memo] = {}


def _readings(r: Restorer, found: Evidence) -> Memo:
    """token -> (its reading, the reading's evidence), kept between batches."""
    key = id(r), id(found)
    if key not in _READINGS:
        _READINGS.clear()

        def read(token: str) -> tuple[str, float]:
            word = r.decoded(token)
            return word, found.word(word)

        _READINGS[key] = Memo(read, 125_000, "toxicity")
    return _READINGS[key]


Memo.on_leaving("toxicity", _RESTORERS.clear)
Memo.on_leaving("toxicity", _READINGS.clear)


def _named(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    return labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("toxic"))


def score(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; labels of held-out rows are not read."""
    docs = two_columns(df, id_col, text_col)
    scores, kind = judge(docs, _named(labels, id_col, label_col), fit_rows), _arrow(docs)

    def run(rows):
        for ids, texts in batches(rows, "doc_id", "text"):
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(scores(texts), pa.float64())], ["doc_id", "score"])

    scored = docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())]))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df``, with all their columns, whose score stays below the threshold."""
    scores, at = judge(two_columns(df, id_col, text_col), _named(labels, id_col, label_col)), df.columns.index(text_col)

    def run(rows):
        for batch in rows:
            for part in slices(batch, at):
                texts = [t if t is not None else "" for t in part.column(at).cast(pa.string()).to_pylist()]
                yield part.filter(pa.array([s < threshold for s in scores(texts)], pa.bool_()))

    return df.mapInArrow(run, df.schema)
