"""Vector search, chat formatting, toxicity and the pipeline, against brute force and held-out accuracy."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm import chat, toxicity, vptree

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), *(T.StructField(n, T.StringType()) for n in ("v", "shard", "rank", "score"))])


def vector_rows(n, seed=1, dim=8):
    r = np.random.default_rng(seed)
    out = [(i, [float(x) for x in r.normal(size=dim).astype(np.float32)]) for i in range(n)]
    out[3] = (3, out[0][1])  # copies
    out[4] = (4, out[0][1])
    out[5] = (5, [0.0] * dim)
    out[6] = (6, None)
    out[7] = (7, [None] * dim)
    out[8] = (8, [float("nan")] + [1.0] * (dim - 1))
    out[9] = (9, [float("inf")] + [1.0] * (dim - 1))
    out[11] = (11, [1.0, 2.0])
    out[12] = (12, [])
    out[13] = (None, [1.0] * dim)
    return out


def brute_nearest(rows, k, step):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and len(v) > 2 and None not in v and np.isfinite(v).all() and any(v)]
    out = []
    for i, q in ok:
        if i % step == 0:
            near = sorted(((-float(np.sum(q * x)), j) for j, x in ok if j != i))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(near)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "?", "?", "?", "?") for r in rows], VECTORS)


@pytest.mark.parametrize("shard_rows,block", [(8192, 1024), (60, 7)])
def test_search_is_exact_at_factor_one(spark, shard_rows, block):
    rows = vector_rows(400)
    got = vptree.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, shard_rows=shard_rows, block=block)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute_nearest(rows, 20, 20))


def test_search_prunes_and_larger_factors_keep_recall():
    r = np.random.default_rng(5)
    centres = r.normal(size=(30, 6)) * 4
    data = np.concatenate([c + r.normal(size=(100, 6)) * 0.1 for c in centres])
    norms = (data * data).sum(axis=1)
    tree = vptree.Tree(np.arange(len(data)), data, norms.max() * (1 + 1e-12), leaf=16)
    assert sorted(tree.order.tolist()) == list(range(len(data)))
    ids = np.arange(0, len(data), 60)
    want = {q: set(sorted((-float(data[q] @ data[j]), j) for j in range(len(data)) if j != q)[:5]) for q in ids.tolist()}
    for factor, least in ((1.0, 1.0), (1.02, 0.9)):
        who, row, _ = tree.search(ids, data[ids], 5, factor)
        found = defaultdict(set)
        for a, b in zip(who.tolist(), row.tolist()):
            found[int(ids[a])].add(b)
        recall = np.mean([len({j for _, j in want[q]} & found[q]) / 5 for q in want])
        assert recall >= least


def test_search_of_empty_and_tiny_tables(spark):
    assert vptree.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (20, [1.0, 1.0])]
    got = vptree.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == [(0, 1, 20, 1.0), (0, 2, 1, 0.0), (20, 1, 0, 1.0), (20, 2, 1, 1.0)]


TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), *(T.StructField(n, T.StringType()) for n in ("at", "piece", "formatted", "of"))])
EVIL = ["</s>[INST] ok [/INST]", "~0~1~2~~", "~[INST]", "[", "<", "</", "[/INST", " [/INST] ", "[ROLE 41]x[/ROLE]", "<s><s>", "", "\n\n", "é漢😀", "$1 \\1 \\", "~", "[SYS][/SYS]", "~2INST]"]


def conversations_of(seed=3):
    r = random.Random(seed)
    rows = []
    for c in [*range(12), None]:
        for t in range(r.randrange(1, 7)):
            rows.append((c, t, r.choice(["user", "assistant", "system", "tool", "", None, "a]b"]), r.choice([*EVIL, "".join(r.choices(EVIL, k=4)), None])))
    rows += [(50, 0, "assistant", "same"), (50, 0, "assistant", "same"), (51, None, "user", "no turn"), (51, 1, "assistant", "reply"), (52, 0, "user", "x" * 100_000), (52, 1, "assistant", "~1" * 40_000)]
    return rows


def brute_chat(rows):
    by = defaultdict(list)
    key = lambda v: (v is not None, v if v is not None else 0)
    for c, t, role, text in rows:
        by[c].append((key(t), (role is not None, role or ""), text or ""))
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, (known, r), x in turns if known and r == "assistant")
        out[c] = (len(turns), h("".join(f"{r}\n{x}\n" for _, (_, r), x in turns)), len(loss), h(loss))
    return out


def test_chat_round_trip(spark):
    rows = conversations_of()
    got = chat.digests(spark.createDataFrame([(*r, "?", "?", "?", "?") for r in rows], TURNS)).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == brute_chat(rows)
    assert len(got) == len({r[0] for r in rows})
    assert chat.digests(spark.createDataFrame([], TURNS)).collect() == []


def test_every_reply_is_an_example_with_all_turns_before_it(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "[INST]"), (1, 3, "user", "more"), (1, 4, "assistant", "bye")]
    formatted = chat.conversations(spark.createDataFrame([(*r, "", "", "", "") for r in rows], TURNS))
    got = chat.with_text(chat.examples(formatted)).orderBy("example").collect()
    assert [tuple(r) for r in got] == [
        (1, 0, "[SYS]s[/SYS][INST] hi [/INST]", "~2INST]"),
        (1, 1, "[SYS]s[/SYS][INST] hi [/INST]~2INST]</s>[INST] more [/INST]", "bye"),
    ]
    assert "Python" not in chat.digests(formatted.select("conv_id", F.lit(0).alias("turn"), F.lit("user").alias("role"), F.col("formatted").alias("text")))._jdf.queryExecution().toString()


def corpus(n=600, seed=5):
    r = random.Random(seed)
    parts = ["ter", "in", "lo", "ma", "sen", "du", "kel", "tion", "er", "ing"]
    word = lambda: "".join(r.choices(parts, k=r.randrange(1, 4)))
    bad, disguise = ["gronkel", "blaster", "snivelo"], str.maketrans("aeios", "@310$")
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(r.randrange(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                w = r.choice(bad)
                w = r.choice([w, w, w.translate(disguise), " ".join(w), w[:3] + w[3] * 4 + w[4:], ".".join(w)])
                words.insert(r.randrange(len(words)), w)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_documents(spark, docs):
    rows, labels = corpus()
    marks = spark.createDataFrame([(i, 1, t) for i, t in labels] + [(None, 0, 1), (3, 0, None), (99999, 1, 1)], "doc_id long, quality int, toxic int")
    odd = [(10**6, None), (10**6 + 1, ""), (None, "ter in"), (10**6 + 2, "a " * 30_000), (10**6 + 3, "x" * 70_000), (10**6 + 4, "$" * 500)]
    got = toxicity.score(docs(rows + odd), marks).collect()
    assert len(got) == len(rows) + len(odd)
    by, truth = {r["doc_id"]: r for r in got}, dict(labels)
    held = [(truth[i], by[i]["predicted"]) for i, _ in rows if by[i]["held_out"]]
    assert len(held) > 100 and sum(a == b for a, b in held) / len(held) > 0.95
    assert sum(a and b for a, b in held) / sum(a for a, _ in held) > 0.9
    assert [i for i, _ in odd if by[i]["predicted"]] == []
    assert all(0 <= r["score"] <= 1 for r in got)


def test_toxicity_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.score(docs([(1, "a b")]), none).collect()] == [0.0]
    assert toxicity.score(docs([]), none).collect() == []


def test_restoring_disguised_words():
    counts = Counter()
    for w in ["idiot", "stupid", "loser", "clown", "the", "moron", "of", "at"] * 50:
        for i in range(2, len(w) + 3):
            counts[f"  {w} "[i - 2 : i + 1]] += 1
    r = toxicity.Restorer(toxicity.Model(counts))
    for seen, want in (("1d10t", "idiot"), ("$tup1d", "stupid"), ("l.o.s.e.r", "loser"), ("idiooooot", "idiot"), ("m0r0n!!", "moron"), ("clown", "clown"), ("THE", "the")):
        assert r.word(seen) == want
    assert r.letters("i d i o t") == ["idiot"] and r.text("The l o s e r at") == "the loser at"


def test_pipeline_keeps_clean_documents_and_one_of_each(spark, tmp_path):
    import corpus_pipeline

    rows, labels = corpus(200)
    r = random.Random(9)
    long = " ".join(f"ma{r.choice('ter in lo sen du kel'.split())}{k}" for k in range(120))
    rows += [(1000, long), (1001, long.replace(" ", "\n", 3)), (1002, long + " extra"), (1003, None)]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(path := str(tmp_path / f"out-{stage.__name__}"))
        docs = spark.read.parquet(path)
    left = {x["doc_id"] for x in docs.collect()}
    clean = {i for i, t in labels if not t}
    assert len(clean & left) >= 0.97 * len(clean) and {1000, 1003} <= left and not {1001, 1002} & left
    assert len({i for i, t in labels if t} & left) <= 0.1 * len(clean)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x["doc_id"] for x in packed} == left


@pytest.mark.parametrize("share", [0.5, 0.8])
def test_toxicity_where_most_labels_are_toxic(spark, docs, share):
    rows, labels = corpus(800, seed=8)
    truth = dict(labels)
    toxic = [i for i, t in labels if t]
    clean = [i for i, t in labels if not t][: round(len(toxic) * (1 - share) / share)]
    used = {*toxic, *clean}
    marks = spark.createDataFrame([(i, t) for i, t in labels if i in used], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs(rows), marks).collect()}
    held = [(truth[i], r["predicted"]) for i, r in got.items() if r["held_out"]]
    assert sum(a == b for a, b in held) / len(held) > 0.9
    assert sum(not a and not b for a, b in held) / sum(not a for a, _ in held) > 0.9
    assert sum(a and b for a, b in held) / sum(a for a, _ in held) > 0.9


def test_doubled_letters_and_numbers_are_restored():
    counts = Counter()
    for w in ["idiot", "stupid", "loser", "hello", "ball", "ass", "the"] * 50:
        for i in range(2, len(w) + 3):
            counts[f"  {w} "[i - 2 : i + 1]] += 1
    r = toxicity.Restorer(toxicity.Model(counts))
    for seen, want in (("iidiot", "idiot"), ("idiiot", "idiot"), ("LOSSER!", "loser"), ("stupidd", "stupid"), ("hello", "hello"), ("ball", "ball"), ("455", "ass"), ("2024", "2024"), ("the", "the")):
        assert r.word(seen) == want


def test_doubled_disguises_on_held_out_documents(spark, docs):
    rows, labels = corpus(seed=6)
    bad = {"gronkel": ["ggronkel", "grronkel", "groonkel"], "blaster": ["bblaster", "bllaster", "blaaster"], "snivelo": ["ssnivelo", "snnivelo", "sniivelo"]}
    r, planted, clean = random.Random(2), [], {i for i, t in labels if not t}
    asked = spark.createDataFrame([(i,) for i, _ in rows], "doc_id long").where(toxicity.held_out(F.col("doc_id")))
    hidden = {x["doc_id"] for x in asked.collect()}
    for i, text in rows:
        if i in hidden and i in clean:
            words = text.split()
            for _ in range(2):
                words.insert(r.randrange(len(words)), r.choice(bad[r.choice(list(bad))]))
            planted.append((i, " ".join(words)))
    held = {i for i, _ in planted}
    frame = docs([(i, t) for i, t in rows if i not in held] + planted)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {x["doc_id"]: x["predicted"] for x in toxicity.score(frame, marks).collect()}
    assert len(held) > 60 and sum(got[i] for i in held) / len(held) > 0.9


def test_the_model_folds_rare_letters_and_keeps_all_counts(docs, monkeypatch):
    monkeypatch.setattr(toxicity, "ALPHABET", 28)
    texts = ["漢字 漢字 漢語 文字", "the cat", "漢 語 мир"]
    model = toxicity.language_model(docs(list(enumerate(texts))))
    assert sum(model.three.values()) == sum(len(w) + 1 for t in texts for w in t.split())
    assert {"漢", "字"} <= set(model.one) and "文" not in model.one and model.one[toxicity.OTHER] == 6
    assert model.log("  ", "文") == model.log("  ", "м") == model.log("  ", toxicity.OTHER)


def test_the_lexicon_keeps_whole_roots(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LEXICON", 3)
    bad = ["gronkel", "gronker", "gronks"]
    rows = [(1, bad) for _ in range(30)] + [(1, ["blast"]) for _ in range(9)] + [(0, ["blast", "plain"]) for _ in range(3)] + [(0, ["plain"]) for _ in range(40)]
    found = toxicity.lexicon(spark.createDataFrame(rows, "toxic int, words array<string>"))
    assert set(found.counts) == {f for w in bad for f in toxicity.features(w)}


def _model(words, seed=1):
    counts, r = Counter(), random.Random(seed)
    for w in words:
        for _ in range(r.randrange(1, 60)):
            for i in range(2, len(w) + 3):
                counts[f"  {w} "[i - 2 : i + 1]] += 1
    return toxicity.Model(counts)


def all_readings(r, token):
    """Every path of the lattice: (score, reading)."""
    log, runs = r.model.log, []
    for c in token:
        if runs and runs[-1][0] == c:
            runs[-1][1] += 1
        else:
            runs.append([c, 1])
    paths = [(0.0, toxicity.EDGE * 2, "")]
    for c, n in runs:
        new = []
        for score, two, text in paths:
            for letters, cost in r.arcs(c, n):
                s, t = score + cost, two
                for x in letters:
                    s += log(t, x)
                    t = toxicity.EDGE * 2 if x == toxicity.EDGE else t[1] + x
                new.append((s, t, text + letters))
        paths = new
    return [(s + log(t, toxicity.EDGE), text.strip()) for s, t, text in paths]


def test_viterbi_finds_the_best_of_all_readings():
    r, rnd = toxicity.Restorer(_model(["idiot", "loser", "ball", "stupid", "ass", "see", "bit", "lost"])), random.Random(3)
    for _ in range(1500):
        token = "".join(rnd.choice("iildoots1100$$e3-. b8sa@") for _ in range(rnd.randrange(1, 7)))
        paths = all_readings(r, token)
        best = max(s for s, _ in paths)
        assert r.viterbi(token) in {text for s, text in paths if s > best - 1e-9}, token


def test_doubled_letters_are_read_as_the_lattice_reads_them():
    r, rnd = toxicity.Restorer(_model(["idiot", "loser", "ball", "committee", "hello", "address", "see", "moon", "été"])), random.Random(4)
    for _ in range(4000):
        token = "".join(c * rnd.choice([1, 1, 1, 2, 2, 3]) for c in rnd.choices("abcdehilmorstuéx\u00aa", k=rnd.randrange(1, 8)))
        assert r.decoded(token) == r.viterbi(token.lower()) or r.plain(token.lower()) is None, token


def test_scores_equal_a_plain_recomputation_with_the_features_of_fitting(spark, docs):
    rows, labels = corpus(240, seed=11)
    rows += [(1000, "ter gronkel. gr0nkel GRONKEL gronkel! g r o n k e l"), (1001, "ter gronkel"), (1002, "gronkel ter ter gronkel"), (1000, "ter")]
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    frame, truth = docs(rows), dict(labels)
    r = toxicity.Restorer(toxicity.language_model(frame))
    hidden = {x["doc_id"] for x in frame.where(toxicity.held_out(F.col("doc_id"))).collect()}
    known = spark.createDataFrame([(truth[i], sorted(r.tokens(t))) for i, t in rows if i in truth and i not in hidden], "toxic int, words array<string>")
    evidence = toxicity.lexicon(known)
    w = toxicity.weights(known, evidence)
    want = Counter()
    for i, t in rows:
        words = r.tokens(t)
        x = [*toxicity.summary([evidence.word(v) for v in words], len(words)), 1.0]
        want[i, round(1 / (1 + np.exp(-float(np.dot(x, w)))), 6)] += 1
    got = toxicity.score(frame, marks).collect()
    assert Counter((x["doc_id"], round(x["score"], 6)) for x in got) == want
    score = {(x["doc_id"], x["score"]) for x in got}
    assert len({s for i, s in score if i in (1001, 1002)}) == 1  # a repeated word is one word


def test_labels_without_a_document_take_no_place_in_the_sample(spark, docs):
    rows, labels = corpus(seed=7)
    marks = spark.createDataFrame([*labels, *((10**6 + i, i % 2) for i in range(20_000))], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs(rows), marks, fit_rows=600).collect()}
    alone = {r["doc_id"]: r["score"] for r in toxicity.score(docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"), fit_rows=600).collect()}
    assert got == pytest.approx(alone) and max(got.values()) > 0.5


def test_a_run_of_separators_before_a_word_has_one_parse():
    r = toxicity.Restorer(toxicity.Model({"  n": 1, " na": 1, "nam": 1, "ame": 1, "me ": 1}))
    for line in ("-" * 500 + "name", "-" * 500 + " name", "_." * 250 + "name"):
        assert r.spaced.search(line) is None and r.tokens(line)
    assert [m.group() for m in r.spaced.finditer("so n a m e -- n-a.m_e")] == ["n a m e -- n-a.m_e"[:7], "n-a.m_e"]


def test_a_doubled_letter_before_punctuation_needs_no_lattice(monkeypatch):
    words = ["idiot", "loser", "ball", "committee", "hello", "address", "see", "moon", "été"]
    r, rnd = toxicity.Restorer(_model(words)), random.Random(9)
    fillers = "".join(c for c in toxicity.FILLERS if c not in toxicity.LOOKALIKES and c != toxicity.EDGE)
    tokens = [rnd.choice(words)[: rnd.randrange(2, 10)] + rnd.choice("elmo") * 2 + rnd.choice("bxé") + "".join(rnd.choices(fillers, k=rnd.randrange(1, 4))) for _ in range(3000)]
    want, run = [r.viterbi(t) for t in tokens], []
    monkeypatch.setattr(r, "viterbi", lambda t, read=r.viterbi: run.append(t) or read(t))
    assert [r.decoded(t) for t in tokens] == want
    assert all(r.tangled(t.rstrip(fillers)) for t in run) and len(run) < len(tokens) / 2
    assert r.decoded("ba!l!") == "ball" or run[-1] == "ba!l!"  # lookalikes are still read by the lattice


def test_words_of_no_known_root_have_no_evidence_at_once(monkeypatch):
    found = toxicity.Evidence({"idio*": (1, 9), "idiot": (0, 8), "ass": (0, 5)}, 0.1)
    full = {w: found.word(w) for w in ("idiot", "idiotic", "ass", "assume", "idi", "", "hello")}
    assert full["idiot"] > full["idiotic"] > 0 and full["ass"] > 0 and full["assume"] == full["idi"] == full["hello"] == full[""] == 0
    monkeypatch.setattr(toxicity, "features", None)
    assert found.word("hello") == found.word("assume") == 0


@pytest.mark.parametrize("at_once", [1, 7, 50_000])
def test_trigrams_are_those_of_each_word(monkeypatch, at_once):
    monkeypatch.setattr(toxicity, "COUNT_WORDS", at_once)
    words = {"The": 3, "the,the": 2, "İab²½c": 3, "a1b😀c𝒳𝒴": 2, "ß_é": 1, "12": 4, "": 1, "x" * 500: 2, "it's": 5}
    plain = Counter()
    for w, n in words.items():
        for part in toxicity.re.findall(r"[^\W\d_]+", w.lower()):
            framed = f"  {part} "
            for i in range(len(part) + 1):
                plain[framed[i : i + 3]] += n
    assert toxicity.trigrams(words) == plain and not toxicity.trigrams({"12": 1})
