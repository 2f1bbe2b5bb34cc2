"""Jump-hash shards, collocations and conversation repair: brute force, round trips, dirty rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stratum.llm import collocations as C
from stratum.llm import repair as R
from stratum.llm import sharding as S
from stratum.session import scratch_path

SF = "/root/testdata/sf0.001"
FULL = (1 << 64) - 1

# ------------------------------------------------------------------ shards


def published_jump(key: int, n: int) -> int:
    key, b, j = key & FULL, -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) & FULL
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_equals_the_published_loop(spark):
    rnd = random.Random(1)
    keys = [0, 1, -1, 42, 2**63 - 1, -(2**63), *(rnd.randint(-(2**63), 2**63 - 1) for _ in range(300))]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 3, 16, 17, 1000):
        got = {r["k"]: r["s"] for r in df.select("k", S.jump(F.col("k"), n)["shard"].alias("s")).collect()}
        assert got == {k: published_jump(k, n) for k in keys}


def test_a_key_stays_until_moves(spark):
    df = spark.range(400).select("id", *(S.jump(F.col("id"), n).alias(f"j{n}") for n in range(1, 13)))
    for r in df.collect():
        for n in range(1, 12):
            now, later = r[f"j{n}"], r[f"j{n + 1}"]
            assert later["shard"] == (n if now["moves"] == n else now["shard"])


DIRTY = [
    (1, "a b", "x"), (1, "a b", "x"), (1, "c", "x"), (None, None, None), (None, "", "y"), (2, "é中" * 3, "z"), (3, "long " * 200_000, "z"),
    *((7, "hot", "w") for _ in range(300)), *((i, f"text {i}", "v") for i in range(100, 400)),
]


def _dirty(spark):
    cols = "doc_id long, text string, shard string"
    return spark.createDataFrame(DIRTY, cols).withColumn("slot", F.lit(5)).withColumn("row", F.lit("r")).withColumn("moves", F.lit(0)).repartition(5)


def test_digests_number_every_row_of_every_shard(spark):
    rows = S.digests(_dirty(spark), scratch_path(spark, "shards"), 16).collect()
    null_key = spark.range(1).select(F.xxhash64(F.lit(None).cast("long"))).first()[0]
    want = Counter()
    for i, text, _ in DIRTY:
        key, body = null_key if i is None else i, (text or "").encode()
        want[(i, len(body) + 1, zlib.crc32(body), "key", published_jump(key, 16), published_jump(key, 17))] += 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_growing_moves_only_what_the_new_shards_take(spark):
    path, df = scratch_path(spark, "grow"), spark.range(2000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    S.write(df, path, 8, ["doc_id"])
    S.grow(spark, path, 8, 9)
    S.grow(spark, path, 8, 9)  # again: the generation is replaced
    S.grow(spark, path, 9, 12)
    for n in (8, 9, 12):
        rows = S.read(spark, path, n).select("row.doc_id", "row.text", "shard").collect()
        assert sorted(r["doc_id"] for r in rows) == list(range(2000)) and all(r["shard"] == published_jump(r["doc_id"], n) and r["text"] == str(r["doc_id"]) for r in rows)
    assert spark.read.parquet(f"{path}/rows/shards=9").count() == sum(published_jump(i, 9) == 8 for i in range(2000))
    with pytest.raises(ValueError):
        S.read(spark, path, 10)
    numbered = S.number(S.read(spark, path, 12)).groupBy("shard").agg(F.min("slot").alias("a"), F.max("slot").alias("b"), F.count_distinct("slot").alias("n"), F.count("*").alias("m")).collect()
    assert all(r["a"] == 0 and r["b"] + 1 == r["n"] == r["m"] for r in numbered)


def test_text_keys_and_an_empty_table(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "name string, n int")
    path = scratch_path(spark, "names")
    S.write(df, path, 5, ["name", "n"])
    want = {r["n"]: published_jump(r["k"], 5) for r in df.select("n", F.xxhash64("name", "n").alias("k")).collect()}
    assert {r["n"]: r["shard"] for r in S.read(spark, path, 5).select("row.n", "shard").collect()} == want
    assert S.digests(_dirty(spark).limit(0), scratch_path(spark, "none"), 16).collect() == []


def test_sharding_plan_is_native(spark):
    plan = S.digests(_dirty(spark), scratch_path(spark, "plan"), 16)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Arrow", "Cartesian", "NestedLoop") if x in plan]


# ------------------------------------------------------------- collocations


def brute_phrases(rows, least, inside, top):
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = lang or "und", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            ws = [w for w in re.split("[\x20\x09]+", piece) if w]
            total[lang] += len(ws)
            for d in (1, 2, 3):
                count[lang].update(tuple(ws[i : i + d]) for i in range(len(ws) - d + 1))
    out = []
    for lang, f in count.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= inside * a for q, b in cand.items()):
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def _texts():
    rnd = random.Random(2)
    words = ["the", "of", "New", "york", "été", "x", "中文", "big", "\xa0", "apple"]
    rows = [(rnd.choice(["en", "de", None, "und"]), "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ". ", "\n", ", ", "\x0b"]) for _ in range(rnd.randint(0, 60)))) for _ in range(120)]
    return [*rows, *rows[:20], ("en", None), (None, ""), ("de", " ..,\n"), ("en", "new york " * 3000), ("fr", "a b " * 4 + "a")]


@pytest.mark.parametrize(("group_rows", "stretch"), [(250_000, 1 << 22), (20, 64), (3, 1000)])
def test_collocations_equal_brute_force(spark, monkeypatch, group_rows, stretch):
    monkeypatch.setattr(C, "STRETCH", stretch)
    rows = _texts()
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "lang string, text string, w1 int, phrase string").repartition(4)
    for least, inside, top in ((2, 50, 2000), (10, 30, 7)):
        got = C.collocations(df, least=least, inside=inside, top=top, group_rows=group_rows).collect()
        assert sorted(tuple(r) for r in got) == brute_phrases(rows, least, inside, top)


def test_suffix_counts_cover_every_word(spark):
    rows = _texts()
    counted = C.suffixes(spark.createDataFrame(rows, "lang string, text string"))
    n = sum(len(re.findall("[^\x20\x09.,;:!?\x0a-\x0d]+", t or "")) for _, t in rows)
    assert counted.agg(F.sum("total")).first()[0] == n


def test_no_texts_no_collocations(spark):
    assert C.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


# ------------------------------------------------------------------- repair

WHITE = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    space = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        for _ in range(0 if k == 0 else 2 if k == 3 else 1):
            yield conv, turn, "user" if k == 4 else role, text


def brute_repair(rows):
    """Costs from the end, then the least letter that keeps to the cheapest; rows of one conversation in order."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(WHITE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turn, keep = {"": "u", "s": "u", "u": "a", "a": "u"}, {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    n, big = len(rows), 10**9
    cost = [dict.fromkeys(turn, big) for _ in range(n + 1)]
    cost[n][""] = cost[n]["a"] = 0

    def moves(i, s):
        yield "I", 3, i, turn[s]
        if i < n:
            yield "D", 4, i + 1, s
            if faults[i] not in ("blank", "duplicate"):
                extra, first = 3 * (faults[i] == "truncated"), rows[i][2][:1]
                if (s, first) in keep:
                    yield "K", extra, i + 1, first
                yield "R", 3 + extra, i + 1, turn[s]

    for i in range(n, -1, -1):
        for _ in range(4):
            for s in turn:
                cost[i][s] = min(cost[i][s], *(c + cost[j][t] for _, c, j, t in moves(i, s)))
    i, s, audit, lines = 0, "", "", []
    while not (i == n and s in ("", "a") and cost[i][s] == 0):
        edit, _, j, t = min(m for m in moves(i, s) if m[1] + cost[m[2]][m[3]] == cost[i][s])
        audit += edit
        new = {"u": "user", "a": "assistant"}.get(t)
        lines += {"K": lambda: [f"{rows[i][2]}:{rows[i][3]}"], "R": lambda: [f"{new}:{rows[i][3]}"], "I": lambda: [f"{new}:"], "D": list}[edit]()
        i, s = j, t
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost[0][""], audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_digests(rows):
    convs = {r[0]: [] for r in rows}
    for r in brute_damage(rows):
        convs[r[0]].append(r)
    order = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).hexdigest())
    return {c: brute_repair(sorted(rs, key=order)) for c, rs in convs.items()}


def _digests(df):
    return {r["conv_id"]: tuple(r)[1:] for r in R.digests(df).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def _random_rows(rnd, n):
    return [(1, i, rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rnd.choice(["a.", "b!", "c", "", "d?", "e. ", "\t"])) for i in range(n)]


def _inputs(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(WHITE)
        out.append((role[:1], not body or (role, text) in seen, bool(body) and body[-1] not in ".!?"))
        seen.add((role, text))
    return out


def test_audits_equal_brute_force_whole_and_in_slices():
    rnd = random.Random(3)
    for _ in range(1500):
        rows = _random_rows(rnd, rnd.randint(0, 10))
        want, given = brute_repair(rows)[5:7], _inputs(rows)
        assert R.chosen(R.solve(given)) == want
        at = sorted({0, len(given), *(rnd.randint(0, len(given)) for _ in range(2))})
        slices = [[{"start": s, "end": e, "cost": c, "audit": w} for s in range(4) for e, (c, w) in R.solve(given[a:b], s, last=False).items()] for a, b in zip(at, at[1:])]
        if slices:
            cost, pieces = R.chain(slices)
            assert (cost, "".join(p[1] for p in pieces)) == want


def test_colliding_hashes_are_told_apart():
    rnd = random.Random(4)
    for _ in range(200):
        rows = _random_rows(rnd, rnd.randint(4, 14))
        assert R.chosen(R.solve(_inputs(rows), trail=R.Trail(base=1, modulus=2))) == brute_repair(rows)[5:7]


def test_trail_compares_words_by_their_first_difference():
    rnd, t, nodes = random.Random(5), R.Trail(), [0]
    for _ in range(400):
        nodes.append(t.add(rnd.choice(nodes), rnd.choice("DIKR")))
    for _ in range(3000):
        x, y = rnd.choice(nodes), rnd.choice(nodes)
        assert t.less(x, y) == (t.word(x) < t.word(y))
    for x in nodes[:50]:
        for k in range(t.depth[x] + 1):
            assert t.word(t.before(x, k)) == t.word(x)[: t.depth[x] - k]


def test_repair_of_the_conversations_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert _digests(df) == brute_digests([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("bits", [2, 6])
def test_long_conversations_repeats_nulls_and_ties(spark, monkeypatch, bits):
    monkeypatch.setattr(R, "BLOCK_BITS", bits)
    monkeypatch.setattr(R, "RUN", 16)
    rnd = random.Random(6)
    roles, ends = ["system", "user", "assistant", "user", "assistant", None, "", "ufo"], [".", "!", " ", "", "?"]
    rows = [(7 if rnd.random() < 0.5 else rnd.choice([None, *range(60)]), rnd.choice([None, *range(900)]), rnd.choice(roles), rnd.choice([None, " \t", "x" * 5000, *(f"t{i}{rnd.choice(ends)}" for i in range(50))])) for _ in range(900)]
    rows += [(7, 5, "user", "same.")] * 200 + [(8, 1, "user", None)] * 40
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn int, role string, text string, block int, audit string").repartition(7)
    assert _digests(df) == brute_digests(rows)


def test_repaired_turns_follow_the_grammar(spark):
    fixed = R.repair(R.damaged(spark.read.parquet(f"{SF}/conversations.parquet")))
    by = defaultdict(list)
    for r in fixed.turns.orderBy("block", "seq").collect():
        by[r["conv_id"]].append(r)
    audits = defaultdict(str)
    for r in fixed.audits.orderBy("block").collect():
        audits[r["conv_id"]] += r["audit"]
    for conv, rows in by.items():
        assert "".join(r["edit"] for r in rows) == audits[conv]
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][:1] for r in rows if r["edit"] != "D"))


def test_no_conversations(spark):
    assert _digests(spark.createDataFrame([], "conv_id long, turn int, role string, text string")) == {}
