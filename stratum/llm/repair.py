"""Repair of conversation structure: the cheapest edits, and of equally cheap ones the least audit.

A conversation's roles must read ``(s?(ua)+)?`` by their initials.  A row is kept (free), given the role
user or assistant (3) or deleted (4; blank rows and repeats of an earlier role and text must be), an
empty user or assistant turn may be inserted anywhere (3), and an undeleted truncated row adds 3.  The
audit is the word of the edits' initials; of the cheapest the ASCII-least one is taken.

The dynamic program goes over rows with four states (nothing yet, s, u, a last).  Its strings are
persistent: an edit is a node linked to the node before it (``Trail``), so all states of all rows
share their prefixes.  Nodes carry binary-lifting ancestors and a rolling hash.  Two words of equal
cost are compared by searching their longest common prefix over the ancestors; where hashes agree on
different nodes, the letters are compared as well.  No kept word is a proper prefix of another one
of the same cost, row and state (it would lack an insertion's cost), so the least prefix is always
part of the least word.

Scale: rows are ordered by (conversation, turn, role, text) across the cluster, numbered, and cut into
blocks of ``BLOCK``; no task takes a conversation as a whole.  A block solves each conversation inside
it; for the first and the last one, which may go on in other blocks, it gives the best word from every
state to every state, and such slices (two a block at most) are chained afterwards, by block number.
Repeats are found by a combined minimum per (conversation, role, text), rows that agree in
everything are one entry with a count.  What a conversation's chain holds is its edits, a few letters a
row, never its texts.

Null roles and texts count as one space (an unknown role, a blank text); null turns come first; rows
with a null conv_id are a conversation of their own.  Rows of one turn are ordered by role and
text.  Very long texts are only hashed and trimmed.  An empty table gives empty results.  Other
columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import cut_lineage

WHITE = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
#: Entries of a block, and the most copies of one row in an entry.
BLOCK_BITS = 10
RUN = 256

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: Where a role's initial leads from a state, and where a new or changed turn leads.
KEEP = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
TURN = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")

_BASE, _MODULUS = 911_382_323, (1 << 61) - 1


class Trail:
    """Words as linked nodes that share their prefixes; node 0 is the empty word."""

    def __init__(self, base: int = _BASE, modulus: int = _MODULUS):
        self.base, self.modulus = base, modulus
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [()]

    def add(self, node: int, letter: str) -> int:
        """The node of a word's continuation by a letter; ``up[k]`` is its ancestor 2**k letters before."""
        up, k = [node], 0
        while len(self.up[up[k]]) > k:
            up.append(self.up[up[k]][k])
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.base + ord(letter)) % self.modulus)
        self.up.append(up)
        return len(self.letter) - 1

    def before(self, node: int, letters: int) -> int:
        """The ancestor so many letters before a node."""
        k = 0
        while letters:
            if letters & 1:
                node = self.up[node][k]
            letters >>= 1
            k += 1
        return node

    def same(self, x: int, y: int) -> bool:
        """Whether two nodes of equal depth spell one word: equal hashes are verified letter by letter."""
        if x == y:
            return True
        if self.hash[x] != self.hash[y]:
            return False
        while x != y:
            if self.letter[x] != self.letter[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether word x comes before word y: longest common prefix by lifting, then one letter."""
        dx, dy = self.depth[x], self.depth[y]
        a, b = self.before(x, max(0, dx - dy)), self.before(y, max(0, dy - dx))
        if self.same(a, b):
            return dx < dy
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and not self.same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.letter[a] < self.letter[b]

    def word(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))


class _Best:
    """The best (cost, node) of each state."""

    def __init__(self, trail: Trail):
        self.trail, self.at = trail, {}

    def offer(self, state: int, cost: int, node: int, letter: str) -> bool:
        held = self.at.get(state)
        if held is not None and held[0] < cost:
            return False
        new = self.trail.add(node, letter)
        if held is not None and held[0] == cost and not self.trail.less(new, held[1]):
            return False
        self.at[state] = (cost, new)
        return True

    def insert(self) -> None:
        """Insertions until none helps."""
        changed = list(self.at)
        while changed:
            found = []
            for s in changed:
                cost, node = self.at[s]
                if self.offer(TURN[s], cost + INSERT, node, "I"):
                    found.append(TURN[s])
            changed = found


def solve(rows: list[tuple[str, bool, bool]], start: int = EMPTY, trail: Trail | None = None, last: bool = True) -> dict[int, tuple[int, str]]:
    """Best (cost, audit) per end state of rows (initial, must be deleted, truncated), from a start state.

    ``last`` allows insertions after the last row."""
    best = _Best(trail or Trail())
    best.at[start] = (0, 0)
    for initial, gone, short in rows:
        best.insert()
        then = _Best(best.trail)
        extra = CUT_SHORT if short else 0
        for state, (cost, node) in best.at.items():
            then.offer(state, cost + DELETE, node, "D")
            if not gone:
                kept = KEEP.get(initial, {}).get(state)
                if kept is not None:
                    then.offer(kept, cost + extra, node, "K")
                then.offer(TURN[state], cost + REROLE + extra, node, "R")
        best = then
    if last:
        best.insert()
    return {s: (c, best.trail.word(n)) for s, (c, n) in best.at.items()}


def chosen(ends: dict[int, tuple]) -> tuple:
    """The best of the two accepting ends, as (cost, audit, ...)."""
    return min(ends[s] for s in (EMPTY, ASSISTANT) if s in ends)


class Repaired(NamedTuple):
    """conversations: conv_id, gaps, blank, duplicate, truncated, illegal, cost; turns: conv_id, block, seq, edit,
    turn, role, text (of every edit, deletions too, in the order (block, seq)); audits: conv_id, block, audit."""

    conversations: DataFrame
    turns: DataFrame
    audits: DataFrame


def _ordered(turns: DataFrame) -> DataFrame:
    """Entries in order, written: at, block, conv_id, turn, role, text, copies, run, what, initial, blank, short."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = turns.select("conv_id", "turn", space("role"), space("text")).groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("run", F.explode(F.expr(f"sequence(0L, (n - 1) div {RUN})")))
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    rows = rows.select(
        "conv_id", "turn", "role", "text", "run", F.least(F.lit(RUN), F.col("n") - F.col("run") * RUN).cast("int").alias("copies"),
        F.sha2("text", 256).alias("what"), F.substring("role", 1, 1).alias("initial"), (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("short"),
    )
    order = ["conv_id", "turn", "role", "what", "run"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = cut_lineage(rows.withColumn("at", F.monotonically_increasing_id()), "ordered-turns")
    return rows.withColumn("block", F.shiftright("at", BLOCK_BITS))


_PATH = "array<struct<start:int,end:int,cost:bigint,audit:string>>"


def _block_paths(conv_type: T.DataType):
    schema = T.StructType([T.StructField("conv_id", conv_type)]).add("block", "long").add("whole", "boolean").add("illegal", "long").add("first", "string").add("last", "string")
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        block = table.column("block")[0].as_py()
        names = ("conv_id", "initial", "blank", "short", "copies", "is_first")
        entries = list(zip(*(table.column(n).to_pylist() for n in names)))
        slices, at = [], 0
        while at < len(entries):
            to = at
            while to < len(entries) and entries[to][0] == entries[at][0]:
                to += 1
            rows, illegal, before = [], 0, None
            for _, initial, blank, short, copies, first in entries[at:to]:
                for copy in range(copies):
                    rows.append((initial, blank or copy > 0 or not first, short))
                    illegal += before is not None and before + initial not in LEGAL
                    before = initial
            whole = 0 < at and to < len(entries)
            found = []
            for start in (EMPTY,) if whole else range(4):
                ends = solve(rows, start, last=whole)
                if whole:
                    cost, word = chosen(ends)
                    ends = {EMPTY: (cost, word)}
                found += [{"start": start, "end": end, "cost": cost, "audit": word} for end, (cost, word) in ends.items()]
            slices.append((entries[at][0], block, whole, illegal, rows[0][0], before, found))
            at = to
        cols = list(zip(*slices))
        kinds = [table.schema.field("conv_id").type, pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.string(), arrow]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], [*schema.names, "paths"])

    return run, T.StructType(schema.fields + [T.StructField("paths", T._parse_datatype_string(_PATH))])


def _least_of(old: tuple | None, cost: int, before: tuple | None, start: int, piece: str) -> tuple:
    """The better of two chains (cost, the chain before, start, piece); equal costs are compared from where they part."""
    new = (cost, before, start, piece)
    if old is None or cost < old[0]:
        return new
    if cost > old[0]:
        return old
    words, ends = [], (old, new)
    x, y = ends
    while x is not y:
        words.append((x[3], y[3]))
        x, y = x[1], y[1]
    spelled = ["".join(reversed([w[i] for w in words])) for i in (0, 1)]
    return new if spelled[1] < spelled[0] else old


def chain(slices: list[list[dict]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost and each slice's (start state, audit) of the best word through slices' paths, insertions at the end included."""
    held: dict[int, tuple] = {EMPTY: (0, None, EMPTY, "")}
    for paths in slices:
        then: dict[int, tuple] = {}
        for p in paths:
            if p["start"] in held:
                before = held[p["start"]]
                then[p["end"]] = _least_of(then.get(p["end"]), before[0] + p["cost"], before, p["start"], p["audit"])
        held = then
    ends: dict[int, tuple] = {}
    for state, before in held.items():
        for end, (cost, word) in solve([], state).items():
            ends[end] = _least_of(ends.get(end), before[0] + cost, before, state, word)
    best = ends.get(EMPTY)
    if ASSISTANT in ends:
        last = ends[ASSISTANT]
        best = last if best is None else _least_of(best, *last)
    pieces, node = [], best
    while node[1] is not None:
        pieces.append((node[2], node[3]))
        node = node[1]
    pieces.reverse()
    tail = pieces.pop()[1]  # the insertions at the end belong to the last slice
    if pieces:
        pieces[-1] = (pieces[-1][0], pieces[-1][1] + tail)
    return best[0], pieces


def _chained(table: pa.Table) -> pa.Table:
    table = table.sort_by("block")
    paths, first, last = (table.column(n).to_pylist() for n in ("paths", "first", "last"))
    cost, pieces = chain(paths)
    illegal = [i + (k > 0 and last[k - 1] + first[k] not in LEGAL) for k, i in enumerate(table.column("illegal").to_pylist())]
    costs = [cost] + [0] * (len(pieces) - 1)
    return pa.table(
        [table.column("conv_id"), table.column("block"), pa.array(illegal, pa.int64()), pa.array(costs, pa.int64()), pa.array([p[0] for p in pieces], pa.int32()), pa.array([p[1] for p in pieces], pa.string())],
        ["conv_id", "block", "illegal", "cost", "start", "audit"],
    )


def _block_turns(entries: pa.Table, pieces: pa.Table) -> pa.Table:
    """A block's edits, read off its conversations' audits."""
    entries = entries.sort_by("at")
    words = {c: (s, w) for c, s, w in zip(*(pieces.column(n).to_pylist() for n in ("conv_id", "start", "audit")))}
    conv, turn, role, text, copies = (entries.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "copies"))
    out, at = [], 0
    while at < len(conv):
        to = at
        while to < len(conv) and conv[to] == conv[at]:
            to += 1
        rows = (i for i in range(at, to) for _ in range(copies[i]))
        state, word = words[conv[at]]
        for edit in word:
            i = None if edit == "I" else next(rows)
            if edit == "K":
                state = KEEP[role[i][:1]][state]
            elif edit != "D":
                state = TURN[state]
            now = ROLE[state] if edit in "IR" else role[i]
            out.append((conv[at], len(out), edit, None if i is None else turn[i], now, "" if i is None else text[i]))
        at = to
    cols = list(zip(*out)) if out else [()] * 6
    block = pa.array([entries.column("block")[0].as_py()] * len(out), pa.int64())
    kinds = [entries.schema.field("conv_id").type, pa.int64(), pa.string(), entries.schema.field("turn").type, pa.string(), pa.string()]
    arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
    return pa.table([arrays[0], block, *arrays[1:]], ["conv_id", "block", "seq", "edit", "turn", "role", "text"])


def repair(turns: DataFrame) -> Repaired:
    """Repair every conversation of turns (conv_id, turn, role, text)."""
    rows = _ordered(turns)
    conv, turn = rows.schema["conv_id"].dataType, rows.schema["turn"].dataType
    firsts = rows.where("run = 0").groupBy("conv_id", "role", "what").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first_seen"))
    marked = rows.select("at", "block", "conv_id", "turn", "initial", "blank", "short", "copies").join(firsts, "at", "left")
    marked = cut_lineage(marked.withColumn("is_first", F.coalesce("first_seen", F.lit(False))).drop("first_seen"), "marked-turns")

    run, schema = _block_paths(conv)
    found = cut_lineage(marked.drop("turn").groupBy("block").applyInArrow(run, schema), "paths")
    best = F.col("paths")[0]
    whole = found.where("whole").select("conv_id", "block", "illegal", best["cost"].alias("cost"), best["start"].alias("start"), best["audit"].alias("audit"))
    pieces = whole.unionByName(found.where("NOT whole").groupBy("conv_id").applyInArrow(_chained, whole.schema))
    pieces = cut_lineage(pieces, "audits")

    out = T.StructType([T.StructField("conv_id", conv)]).add("block", "long").add("seq", "long").add("edit", "string")
    out = out.add("turn", turn).add("role", "string").add("text", "string")
    narrow = rows.select("at", "block", "conv_id", "turn", "role", "text", "copies")
    repaired = narrow.groupBy("block").cogroup(pieces.groupBy("block")).applyInArrow(_block_turns, out)

    count = lambda c: F.sum(c).cast("long")
    one = F.col("is_first").cast("int")
    faults = marked.groupBy("conv_id").agg(
        _gaps().alias("gaps"),
        count(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        count(F.when(~F.col("blank"), F.col("copies") - one).otherwise(0)).alias("duplicate"),
        count(F.when(~F.col("blank") & F.col("short"), one).otherwise(0)).alias("truncated"),
    )
    costs = pieces.groupBy("conv_id").agg(count("illegal").alias("illegal"), count("cost").alias("cost")).withColumnRenamed("conv_id", "_conv")
    each = faults.join(costs, faults["conv_id"].eqNullSafe(costs["_conv"])).drop("_conv")
    return Repaired(each, repaired, pieces.select("conv_id", "block", "audit"))


def _gaps() -> Column:
    """Turn numbers missing between the least and the largest; 0 if all turns are null."""
    wide = lambda c: c.cast("decimal(38,0)")
    missing = wide(F.max("turn")) - wide(F.min("turn")) + 1 - wide(F.count_distinct("turn"))
    return F.coalesce(missing.cast("long"), F.lit(0).cast("long"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) with faults by the crc32 of ``conv_id:turn`` modulo 20; nulls become one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")), F.lit(20))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(space("role"))
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    held = turns.select("conv_id", "turn", "role", "text").withColumn("fault", fault).where("fault <> 0")
    held = held.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))))
    return held.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def digests(turns: DataFrame) -> DataFrame:
    """Damage and repair: one row per conv_id with its faults, cost, audit and the hash of what it became."""
    fixed = repair(damaged(turns))
    listed = F.sort_array(F.collect_list(F.struct("block", "audit")))
    audits = fixed.audits.groupBy("conv_id").agg(F.array_join(F.transform(listed, lambda x: x["audit"]), "").alias("audit"))
    line = F.struct("block", "seq", F.concat_ws(":", "role", "text").alias("line"))
    lines = fixed.turns.where("edit <> 'D'").groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(line)), lambda x: x["line"]), "\n").alias("lines"))
    out = turns.select("conv_id").distinct()
    for found in (fixed.conversations, audits, lines.select("conv_id", F.sha2("lines", 256).alias("repaired_sha256"))):
        found = found.withColumnRenamed("conv_id", "_conv")
        out = out.join(found, out["conv_id"].eqNullSafe(found["_conv"]), "left").drop("_conv")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
