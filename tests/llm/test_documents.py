"""Operators on documents, on small tables with nulls, ties, repeats, long texts and clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from stratum.session import cut_lineage
from stratum.llm import bpe_documents, exact_dedup, fuzzy_lines, ngram_join, packing, token_counts, token_files
from stratum.llm.components import components

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = [(1, None), (2, ""), (3, " \n"), (None, "no id"), (None, None), (5, "Twice here"), (5, "Twice here"), (-7, "Below zero <|endoftext|> é漢"), (2**60, "x" * 5000), (8, "word " * 6000), (9, "Twice\there")]


def ids(path, text):
    return tokenizers.Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("rows", [ODD, []])
def test_token_counts(docs, rows):
    got = Counter(tuple(r) for r in token_counts.totals(docs(rows), BYTE).collect())
    assert got == Counter((i, len((t or "").encode()), len(ids(BYTE, t)), len(ids(BYTE, t)) > 1024) for i, t in rows)


def test_budget_questions(docs):
    text = "the quick  brown fox isn't here"
    table = token_counts.prefix_counts(docs([(1, text)]), BYTE)
    row = table.select(token_counts.count_at(F.lit(9)).alias("at"), token_counts.longest_within(F.lit(4)).alias("fits")).first()
    counts = [len(ids(BYTE, text[:i])) for i in range(len(text) + 1)]
    assert row["at"] == counts[9]
    assert row["fits"] == max(i for i, n in enumerate(counts) if n <= 4)


@pytest.mark.parametrize("rows", [ODD, []])
def test_bpe_round_trip(docs, rows):
    library = tokenizers.Tokenizer.from_file(WORD)
    hexed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter((i, len(x := ids(WORD, t)), hexed(" ".join(map(str, x))), hexed(library.decode(x, skip_special_tokens=False))) for i, t in rows)
    assert Counter(tuple(r) for r in bpe_documents.digests(docs(rows), WORD).collect()) == want


@pytest.mark.parametrize("rows", [ODD, []])
def test_packing_holds_every_id_once(docs, rows):
    frame = docs(rows)
    held = frame.select("doc_id", "text")
    parts = cut_lineage(packing.pieces(held, WORD), "parts")
    placed = packing.place(parts.drop("ids"), frame.count())
    found = {(r["row"], r["start"]): r for r in placed.collect()}
    texts = Counter()
    for r in parts.collect():
        p = found[r["row"], r["start"]]
        assert p["length"] == len(r["ids"]) // 4 <= packing.LENGTH
        texts[r["row"]] += p["length"]
    assert sorted(texts.values()) == sorted(len(ids(WORD, t)) + 1 for _, t in rows)
    by = {}
    for r in found.values():
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    whole = packing.sequences(parts, placed).collect()
    assert sorted(len(r["ids"]) // 4 for r in whole) == sorted(sum(x for _, x in p) for p in by.values())
    assert set(packing.layout(frame, WORD).columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


def test_first_fit_decreasing_equals_a_scan():
    r = random.Random(2)
    for n in (0, 1, 2, 7, 100, 513):
        sizes = np.array(sorted((r.randrange(1, 65) for _ in range(n)), reverse=True), dtype=np.int64)
        free, want = [], []
        for s in sizes.tolist():
            at = next((b for b, f in enumerate(free) if f >= s), len(free))
            free.extend([64] * (at == len(free)))
            want.append((at, 64 - free[at]))
            free[at] -= s
        bins, offsets = packing.first_fit_decreasing(sizes, 64)
        assert list(zip(bins.tolist(), offsets.tolist())) == want


@pytest.mark.parametrize("rows", [ODD, []])
def test_token_files(docs, rows):
    want, at = [], 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in order:
        x = [*ids(WORD, t), token_files.END_ID]
        want.append((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    got = sorted(token_files.round_trip(docs(rows), WORD).collect(), key=lambda r: r["start"])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(want)
    assert [r["doc_id"] for r in got] == [i for i, _ in order]
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()


def test_elias_fano():
    r = random.Random(4)
    for n, top in ((0, 1), (1, 1), (1, 10**12), (300, 50), (1000, 10**9), (700, 700)):
        values = np.array(sorted(r.randrange(top) for _ in range(n)), dtype=np.int64)
        b = token_files.Boundaries.of(values)
        again = token_files.Boundaries(n, b.low_bits, *b.bytes())
        for a, z in ((0, n), (0, min(1, n)), (n // 3, n // 2), (max(n - 1, 0), n), (n, n)):
            assert again.between(a, z).tolist() == values[a:z].tolist()
        assert [again.select(i) for i in range(n)] == values.tolist()
        assert sum(map(len, b.bytes())) <= 16 + n * (2 + max(0, np.log2(max(top, 1) / max(n, 1)))) / 8 * 1.8 + n / 8


def brute_dedup(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), []).append(i)
    out = Counter()
    for body, members in groups.items():
        known = [i for i in members if i is not None]
        keep, seen = min(known) if known else None, False
        for i in members:
            first = i == keep and not seen
            seen = seen or first
            out[i, keep, len(members), first, hashlib.sha256(body.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("hash_of", [exact_dedup.content_hash, lambda c: F.substring(F.md5(c), 1, 1)], ids=["md5", "colliding"])
@pytest.mark.parametrize("rows", [[*ODD, *((100 + i, f"copy {i % 7}") for i in range(60))], []])
def test_exact_dedup(docs, rows, hash_of):
    got = Counter(tuple(r) for r in exact_dedup.exact_dedup(docs(rows), hash_of=hash_of).collect())
    assert got == brute_dedup(rows)


def test_columns_of_any_name_stay_as_they_are(docs, spark):
    names = ["doc_id", "text", "_text_sha", "_sha", "_id", "_copies", "_component", "_hash", "_text_hash", "h", "body", "keep_id"]
    frame = spark.createDataFrame([(i, t, *range(10)) for i, t in ODD], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names[2:]))
    for keep in (exact_dedup.without_copies, ngram_join.one_of_each):
        got, plain = keep(frame), keep(docs(ODD))
        assert got.columns == names and Counter(r["doc_id"] for r in got.collect()) == Counter(r["doc_id"] for r in plain.collect())
        assert {tuple(r)[2:] for r in got.collect()} == {tuple(range(10))}
        assert keep(frame.limit(0)).collect() == []


def test_a_long_document_stays_out_of_the_groups(docs):
    rows = [(0, "word " * 300_000), *((i, "a few words") for i in range(1, 50))]
    got = packing.layout(docs(rows), WORD).collect()
    full = [r for r in got if r["length"] == packing.LENGTH]
    assert len(full) > 100 and len({r["sequence_id"] for r in full}) == len(full) and all(r["sequence_id"] < 0 and r["offset"] == 0 for r in full)
    assert all(r["sequence_id"] >= 0 for r in got if r["length"] < packing.LENGTH)
    packed = packing.packed(docs(rows), WORD).collect()
    assert sum(r["n_tokens"] for r in packed) == sum(r["length"] for r in got) and max(r["n_tokens"] for r in packed) <= packing.LENGTH


def test_without_copies_keeps_whole_rows(docs):
    got = exact_dedup.without_copies(docs(ODD))
    assert got.columns == docs(ODD).columns
    assert Counter(r["doc_id"] for r in got.collect()) == Counter([1, None, 5, -7, 2**60, 8, 3])


def near(seed, words=120, edits=0):
    r, e = random.Random(seed), random.Random(seed * 31 + edits)
    text = [f"w{r.randrange(5000)}" for _ in range(words)]
    for _ in range(edits):
        text[e.randrange(words)] = f"z{e.randrange(10**6)}"
    return " ".join(text)


def brute_links(rows):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        p = find(k)
        least[p] = i if least.get(p) is None else least[p] if i is None else min(least[p], i)
    return Counter((i, least[find(k)], links[k]) for k, (i, _) in enumerate(rows))


def test_ngram_join(docs):
    rows = [(10 * s + e, near(s, edits=e)) for s in range(12) for e in range(4)] + [(1000 + k, near(1)) for k in range(40)] + [*ODD, (4000, "One two"), (4001, "one TWO")]
    assert Counter(tuple(r) for r in ngram_join.links(docs(rows)).collect()) == brute_links(rows)
    assert ngram_join.links(docs([])).collect() == []


def test_ngram_join_of_a_large_neighbourhood(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL_BAND", 4)
    monkeypatch.setattr(ngram_join, "CHUNK", 8)
    rows = [(k, near(3, words=90, edits=k % 7)) for k in range(70)] + [(100 + k, near(3, words=90, edits=100 + k)) for k in range(40)]
    assert Counter(tuple(r) for r in ngram_join.links(docs(rows)).collect()) == brute_links(rows)


def test_one_of_each_class(docs):
    rows = [(1, near(1)), (2, near(1, edits=1)), (3, near(2)), (4, ""), (5, None), (None, near(2)), (7, near(9)), (7, near(9))]
    got = ngram_join.one_of_each(docs(rows))
    assert got.columns == docs(rows).columns
    assert Counter(r["doc_id"] for r in got.collect()) in (Counter([1, None, 4, 5, 7]), Counter([1, 3, 4, 5, 7]))


def test_pruning_keeps_what_may_reach_the_threshold():
    r = np.random.default_rng(1)
    a = r.integers(0, 60000, (4000, ngram_join.HASHES)).astype("<u2")
    same = r.random(a.shape)
    for share, least, most in ((0.85, 0.999, 1), (0.3, 0, 0.01)):
        b = np.where(same < share, a, a + 1).astype("<u2")
        kept = len(ngram_join.survivors(a, b, np.arange(4000), np.arange(4000))) / 4000
        assert least <= kept <= most


def test_components(spark):
    r = random.Random(8)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, 5000), (None, 3), (1, None)]
    root = {x: x for e in edges for x in e if None not in e}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        if None not in (a, b):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {tuple(r) for r in got} == {(x, find(x)) for x in root} and len(got) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_lines(rows):
    spoken = []
    for i, t in dict.fromkeys(rows):
        for k, line in enumerate((t or "").split("\n")):
            spoken.append((i, k, re.findall(r"[^\W_]+", line.lower())))
    return spoken


def test_fuzzy_lines(docs, spark):
    base = [near(s, words=60) for s in range(6)]
    rows = [(k, "\n".join([base[k % 6], f"own line number {k} {near(100 + k, words=30)}", "", "!!"])) for k in range(12)]
    rows += [(50, base[0].upper() + "!"), (51, base[1].replace("w", "W", 3)), (None, "Null id"), (60, None), (61, "long " + "word " * 200 + "end")]
    rows.append((70, base[2][:-1] + ("0" if base[2][-1] != "0" else "1")))
    got = fuzzy_lines.fuzzy_lines(docs(rows)).collect()
    spoken = brute_lines(rows)
    assert len(got) == len(spoken)
    by = {(r["doc_id"], r["line_no"]): r for r in got}
    for s in range(6):
        copies = [(i, k) for i, k, w in spoken if w == base[s].split()]
        assert {(by[c]["keep_doc_id"], by[c]["keep_line_no"]) for c in copies} == {min(copies)}
        assert [by[c]["kept"] for c in sorted(copies)] == [True] + [False] * (len(copies) - 1)
    for i, k, w in spoken:
        if not w:
            assert by[i, k]["kept"] and by[i, k]["group_lines"] == 1
    assert fuzzy_lines.fuzzy_lines(docs([])).collect() == []


def test_simhash_and_blocks(spark):
    line = " ".join(f"w{k}" for k in range(90))
    lines = [line, line + " more", " ".join([line] * 40), "a", "a b"]
    found = spark.createDataFrame([(x,) for x in lines], "line string").select(F.transform(fuzzy_lines.words(F.col("line")), lambda w: F.xxhash64(w)).alias("h"), fuzzy_lines.simhash(fuzzy_lines.words(F.col("line"))).alias("s")).collect()
    for r in found:
        votes = [sum((h >> b) & 1 for h in r["h"]) * 2 > len(r["h"]) for b in range(64)]
        assert r["s"] & (1 << 64) - 1 == sum(v << b for b, v in enumerate(votes))
    flips = " ^ ".join(f"shiftleft(1L, cast(pmod(xxhash64(id, {k}L), 64) AS int))" for k in range(3))
    sims = spark.range(300).selectExpr("xxhash64(id) AS a", f"xxhash64(id) ^ ({flips}) AS b")
    met = sims.select(F.size(F.array_intersect(fuzzy_lines._keys(F.col("a")), fuzzy_lines._keys(F.col("b")))).alias("n")).agg(F.min("n")).first()[0]
    assert met >= 1


def test_similarity_is_edit_distance(spark):
    pairs = spark.createDataFrame([("abcdefghij", "abcdefghxx"), ("abcdefghij", "abcdefgxxx"), ("", ""), ("a", "")], "a string, b string")
    assert [r[0] for r in pairs.select(fuzzy_lines.similar(F.col("a"), F.col("b"))).collect()] == [True, False, True, False]


def test_decode_of_encode(docs):
    library = tokenizers.Tokenizer.from_file(WORD)
    coded = bpe_documents.decode(bpe_documents.encode(docs(ODD), WORD), WORD)
    want = Counter((i, tuple(ids(WORD, t)), library.decode(ids(WORD, t), skip_special_tokens=False)) for i, t in ODD)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in coded.collect()) == want


def test_fuzzy_groups_equal_all_close_and_similar_pairs(docs, spark):
    """Groups are the components of all pairs within three bits and the edit bound, short lines too."""
    r = random.Random(12)
    vocabulary = ["a", "b", "ab", "abc", "red", "rod", "rid", "lines", "line", "x1", "x2"]
    rows = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randrange(1, 4)))) for k in range(120)]
    rows += [(200 + k, near(5, words=80, edits=k % 9)) for k in range(60)]
    frame = docs(rows)
    got = {r["doc_id"]: r["keep_doc_id"] for r in fuzzy_lines.fuzzy_lines(frame).collect()}
    known = frame.select("doc_id", F.array_join(fuzzy_lines.words(F.col("text")), " ").alias("t"), fuzzy_lines.simhash(fuzzy_lines.words(F.col("text"))).alias("s"))
    a, b = known.toDF("i", "ta", "sa"), known.toDF("j", "tb", "sb")
    pairs = a.crossJoin(b).where("i < j").where((F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= 3) & fuzzy_lines.similar(F.col("ta"), F.col("tb"))).select("i", "j").collect()
    root = {i: i for i, _ in rows}

    def find(x):
        return x if root[x] == x else find(root[x])

    for p in pairs:
        x, y = find(p["i"]), find(p["j"])
        root[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i, _ in rows}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        diag, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            diag, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diag + (c != d))
    return row[-1]


def test_lines_by_grams_are_those_of_the_edit_similarity(docs):
    """Groups are the components of all pairs within the edit bound, whatever their SimHashes."""
    r = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    made = lambda n: " ".join("".join(r.choices(letters, k=r.randrange(2, 9))) for _ in range(n))
    texts = []
    for n in (1, 2, 3, 5, 8, 12, 20, 31):
        for _ in range(4):
            line = made(n)
            changed = line.split()
            changed[r.randrange(n)] = made(1)
            spread = "".join(r.choice(letters) if c != " " and r.random() < 0.1 else c for c in line)
            texts += [line, " ".join(changed), spread, made(n)]
    texts += ["abcde", "abxde", "red", "rod", "a"]
    rows = list(enumerate(texts))
    got = {x["doc_id"]: x["keep_doc_id"] for x in fuzzy_lines.fuzzy_lines(docs(rows), by="grams").collect()}
    root = dict.fromkeys(range(len(texts)))
    root = {k: k for k in root}

    def find(x):
        return x if root[x] == x else find(root[x])

    for i, a in rows:
        for j, b in rows[:i]:
            most = int(max(len(a), len(b)) * 0.2 + 1e-9)
            if abs(len(a) - len(b)) <= most and edit_distance(a, b) <= most:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    want = {i: find(i) for i, _ in rows}
    assert len(set(want.values())) < len(rows) - 40
    assert got == want


def test_one_of_each_keeps_texts_of_white_space_alone(docs):
    blank = ["\u00a0", "\u3000", "\u2028", "\x85", "\x1c\x1d\x1e\x1f", "\u00a0 \n\u3000", " \t\x0b", "", None]
    rows = [*enumerate(blank), (100, near(1)), (101, near(1)), (102, "\u3000" + near(2))]
    assert Counter(r["doc_id"] for r in ngram_join.one_of_each(docs(rows)).collect()) == Counter([*range(len(blank)), 100, 102])


def test_bands_are_never_broadcast(docs, monkeypatch):
    seen, write = [], ngram_join.cut_lineage
    monkeypatch.setattr(ngram_join, "cut_lineage", lambda df, name: seen.append((name, df._jdf.queryExecution().executedPlan().toString())) or df)
    frame = docs([(1, "a")])
    classes = write(frame.sparkSession.createDataFrame([(i, bytes([i % 3]) * 2 * ngram_join.HASHES) for i in range(6)], "cid long, signature binary"), "classes")
    got = ngram_join._bands(classes)
    assert [n for n, _ in seen] == ["bands"] and "Broadcast" not in seen[0][1]
    assert Counter((r["n"], r["lead"], r["cid"]) for r in got.collect()) == {(2, i % 3, i): ngram_join.BANDS for i in range(6)}
