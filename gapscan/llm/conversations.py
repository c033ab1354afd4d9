"""Conversation structure repair: the cheapest edits that give a legal sequence of roles.

A legal conversation is empty or ``s?(ua)+`` in role initials: an optional
system turn, then user and assistant in turn. Edits: Keep (0), Rerole to user or
assistant (2), Delete (3), Insert an empty user or assistant turn (2). Blank and
repeated turns must be deleted; a truncated turn that stays costs 1 more. Of the
cheapest edit lists the one whose initials come first in ASCII order is taken.

Cost. A node is a place between two turns with a state of the grammar (START,
SYSTEM, USER, ASSISTANT). The least cost from each node to the end is a
dynamic program from the last turn to the first, and needs one byte a turn: its
initial and its fault. A conversation may hold a third of all rows, so turns
are range-partitioned and a conversation is solved in *segments*, its runs of
turns in one partition. A segment whose conversation goes on elsewhere is first
reduced to its 4 x 4 table of least costs from state to state; these tables (at
most one a partition and conversation) chained from the back give the costs
behind each segment.

Least path. An arc is optimal if it keeps the least cost. Nodes are ranked by
the first letter of their least audit, then, doubling the length, by the pair
of ranks of a node and of the node that its pointer reaches, while pointers
double too. Ranks choose among a node's optimal arcs, by letter and rank of the
target; the letters of one node's arcs differ, since the grammar is
deterministic. The path is spelled out from the doubled pointers, the longest
first. Long segments are ranked in blocks of ``BLOCK`` turns for each state
they may be entered in; chained from the front, these give the way taken.

Repair. Texts move once: sorted by conversation and place, they stream through
a task that holds the audits and applies them, turn by turn. That one pass a
conversation is sequential (its digest is one SHA-256 over the whole), with
memory for one batch and the audit.

Defined cases: a null conv_id is a conversation of its own; null roles, texts
and turns count as one space where they are compared or hashed; turns without
number come first; rows of equal turn stand in order of role, then of the MD5 of
their text, and rows equal in all three are interchangeable; texts are compared
by MD5; an empty role has no initial; a conversation whose rows are all dropped
has zeros and an empty audit; an empty table gives no rows. Only conv_id, turn,
role and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapscan.llm.common import SPACES
from gapscan.staging import stage

INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
BLOCK = 8192                       # turns whose nodes are ranked together
START, SYSTEM, USER, ASSISTANT = range(4)
WHOLE, CUT, BLANK, REPEATED = range(4)     # the first fault of a turn
INITIALS = "sua"                   # initials with a place in the grammar
LETTERS = "DIKR"                   # in ASCII order
NEVER = 1 << 40
AT_END = np.array([0, 2 * INSERT, INSERT, 0])          # to a legal end without further turns
NEXT = np.array([USER, USER, ASSISTANT, USER])         # the state after an inserted or re-roled turn


def damaged(conversations: DataFrame) -> DataFrame:
    """(ck, conv_id, turn, role, text, gone): the agreed damage by the checksum
    of conv_id and turn. Dropped rows stay, marked ``gone``. ``ck`` names the
    conversation, null ones included."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"),
                                (F.crc32(F.encode(F.concat_ws(":", space("conv_id"), space("turn")), "UTF-8")) % 20).alias("c"),
                                F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("ck"))
    text = (F.when(F.col("c") == 1, "").when(F.col("c") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    copies = F.when(F.col("c") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("ck", "conv_id", "turn", F.when(F.col("c") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("c") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def _in_turn() -> list[Column]:
    """The order of a conversation's rows."""
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]


def _typed(rows: DataFrame) -> DataFrame:
    """(ck, turn, role, digest, uid, code): one narrow row a turn; the code is
    its initial (3: none of s, u, a) and 4 times its first fault."""
    end = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    fault = F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), CUT).otherwise(WHOLE)
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1
    initial = F.when((F.col("role") != "") & (initial >= 0), initial).otherwise(3)
    narrow = stage(rows.where(~F.col("gone")).select(
        "ck", "turn", "role", F.md5("text").alias("digest"), F.monotonically_increasing_id().alias("uid"),
        initial.cast("int").alias("initial"), fault.cast("int").alias("fault")), "turns")
    same, place = ["ck", "role", "digest"], F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "uid")
    # staged, so that both sides of the join come from plain shuffles and a very
    # common turn can be split over tasks
    first = stage(narrow.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
                  .where("n > 1").select(*same, F.col("first.uid").alias("first")), "firsts")
    repeated = F.col("first").isNotNull() & (F.col("first") != F.col("uid")) & (F.col("fault") != BLANK)
    return narrow.join(first, same, "left").select(
        "ck", "turn", "role", "digest", "uid",
        (F.col("initial") + 4 * F.when(repeated, REPEATED).otherwise(F.col("fault"))).alias("code"))


SEGMENT = "ck string, part int, codes binary"


def _gather(batches):
    """Arrow task: (ck, part, code) in order -> one row for each run of a conversation."""
    held, codes, part, done = None, [], 0, []

    def emit():
        cks, found = zip(*done)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(cks), pa.array([part] * len(cks), pa.int32()),
                                           pa.array(found, pa.binary())], ["ck", "part", "codes"])
    for b in batches:
        if not len(b):
            continue
        part = b.column(1)[0].as_py()
        values = b.column(2).to_numpy().astype(np.uint8)
        cks = np.array(b.column(0).to_pylist(), dtype=object)
        change = np.flatnonzero(cks[1:] != cks[:-1]) + 1
        for a, z in zip([0, *change], [*change, len(b)]):
            if held is not None and cks[a] != held:
                done.append((held, b"".join(codes)))
                codes = []
            held = cks[a]
            codes.append(values[a:z].tobytes())
        if done:
            yield emit()
    if held is not None:
        done.append((held, b"".join(codes)))
        yield emit()


def _edit_tables():
    """For each code: cost of Keep, and its state, from every state; cost of Rerole; cost of Delete."""
    keep = np.full((16, 4), NEVER)
    keep_to = np.zeros((16, 4), dtype=int)
    rerole = np.full(16, NEVER)
    for code in range(16):
        initial, fault = code % 4, code // 4
        if fault in (BLANK, REPEATED):
            continue
        extra = TRUNCATED if fault == CUT else 0
        rerole[code] = REROLE + extra
        fits = {0: [(START, SYSTEM)], 1: [(START, USER), (SYSTEM, USER), (ASSISTANT, USER)],
                2: [(USER, ASSISTANT)], 3: []}[initial]
        for q, to in fits:
            keep[code, q], keep_to[code, q] = extra, to
    return keep, keep_to, rerole


KEPT, KEPT_TO, REROLED = _edit_tables()


def _before(code: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Least costs before turns of the given codes, from those after them
    (..., 4): one step of the dynamic program, insertions before the turn included."""
    extra = after.shape[1:-1]
    wide = lambda t: t[code].reshape(len(code), *(1,) * len(extra), -1)
    kept_to = np.broadcast_to(wide(KEPT_TO), after.shape)
    step = np.minimum(wide(KEPT) + np.take_along_axis(after, kept_to, -1), wide(REROLED[:, None]) + after[..., NEXT])
    step = np.minimum(step, DELETE + after)
    once = np.minimum(step, INSERT + step[..., NEXT])
    return np.minimum(once, 2 * INSERT + step[..., NEXT[NEXT]])


def _backwards(codes: list[np.ndarray], after: np.ndarray):
    """Yield (segments, place, costs before that place), from the last turn of
    each segment to its first; all segments step together."""
    sizes = np.array([len(c) for c in codes])
    by_size = np.argsort(-sizes, kind="stable")
    costs = after.copy()
    for back in range(1, int(sizes.max(initial=0)) + 1):
        at = by_size[:int(np.searchsorted(-sizes[by_size], -back, side="right"))]
        place = sizes[at] - back
        costs[at] = _before(np.array([codes[i][p] for i, p in zip(at, place)]), costs[at])
        yield at, place, costs[at]


def _tables(batches):
    """Arrow task: segments -> their least costs from state to state (row by row)."""
    for b in batches:
        codes = [np.frombuffer(c, np.uint8) for c in b.column(2).to_pylist()]
        # costs[i, r, q]: from state q here to state r at the end of the segment
        costs = np.where(np.eye(4, dtype=bool), 0, NEVER)[None].repeat(len(codes), 0)
        for at, _, new in _backwards(codes, costs):
            costs[at] = np.minimum(new, NEVER)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(costs.reshape(len(codes), 16).tolist(), pa.list_(pa.int64()))],
            ["ck", "part", "costs"])


def _chain_back(group: pd.DataFrame) -> pd.DataFrame:
    """The costs behind each segment of a conversation, one row a partition."""
    group = group.sort_values("part", ascending=False)
    behind, out = AT_END, []
    for table in group["costs"]:
        out.append(behind.tolist())
        behind = (np.array(table).reshape(4, 4) + behind[:, None]).min(axis=0)
    return pd.DataFrame({"ck": group["ck"].to_numpy(), "part": group["part"].to_numpy(), "behind": out})


def _paths(codes: np.ndarray, costs: np.ndarray, last: np.ndarray, entries: list[list[int]]):
    """Least audits of blocks of equal length n: codes (b, n), costs (b, n + 1, 4)
    to the end, ``last``: no turn follows the block. For each block and entry
    state: (letters, state at the end)."""
    blocks, n = codes.shape
    places = n + 1
    node = np.arange(blocks * places * 4).reshape(blocks, places, 4)
    here, q = costs, np.arange(4)
    arcs = np.zeros((blocks, places, 4, 4), dtype=bool)       # by letter D, I, K, R
    target = np.repeat(node[..., None], 4, axis=-1)
    after = costs[:, 1:]
    kept_to = KEPT_TO[codes]
    arcs[:, :n, :, 0] = here[:, :n] == DELETE + after
    target[:, :n, :, 0] = node[:, 1:]
    arcs[..., 1] = here == INSERT + here[..., NEXT]
    arcs[~last, n] = False                                     # insertions there belong to the next block
    target[..., 1] = node[..., NEXT]
    arcs[:, :n, :, 2] = here[:, :n] == KEPT[codes] + np.take_along_axis(after, kept_to, -1)
    target[:, :n, :, 2] = np.take_along_axis(node[:, 1:], kept_to, -1)
    arcs[:, :n, :, 3] = here[:, :n] == REROLED[codes][..., None] + after[..., NEXT]
    target[:, :n, :, 3] = node[:, 1:][..., NEXT]
    arcs, target = arcs.reshape(-1, 4), target.reshape(-1, 4)
    ends = ~arcs.any(axis=1)

    # audits of length 1, then 2, 4, 8, ... letters
    rank = np.where(ends, 0, arcs.argmax(axis=1) + 1)
    best = lambda: np.where(arcs, np.arange(4) * (rank.max() + 1) + rank[target], np.iinfo(np.int64).max).argmin(axis=1)
    own = np.arange(len(arcs))
    pointer = np.where(ends, own, target[own, best()])
    pointers = [pointer]
    while not ends[pointer].all():
        rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
        pointer = pointer[pointer]
        pointers.append(pointer)
    letter = best()

    first = np.array([node[b, 0, e] for b in range(blocks) for e in entries[b]])
    path = first[:, None]
    for p in reversed(pointers):
        path = np.stack([path, p[path]], axis=-1).reshape(len(first), -1)
    spelled = np.frombuffer(LETTERS.encode(), np.uint8)[letter[path]]
    length = (~ends[path]).sum(axis=1)
    out, i = [], 0
    for b in range(blocks):
        found = {}
        for e in entries[b]:
            found[e] = (spelled[i, :length[i]].tobytes(), int(q[path[i, -1] % 4]))
            i += 1
        out.append(found)
    return out


def solve(codes: list[np.ndarray], behind: list[list[int] | None], is_last: list[bool], is_first: list[bool]):
    """For each segment {entry state: (audit, exit state)} and the cost from START.

    ``behind``: least costs behind it. A segment that begins a conversation is
    entered in START only."""
    after = np.array([AT_END if b is None else b for b in behind])
    costs = [np.zeros((len(c) + 1, 4), dtype=np.int64) for c in codes]
    for i, c in enumerate(costs):
        c[-1] = after[i]
    for at, place, new in _backwards(codes, after):
        for i, p, v in zip(at, place, new):
            costs[i][p] = v
    # blocks of equal length are ranked together
    by_size: dict[int, list[tuple[int, int]]] = {}
    for i, c in enumerate(codes):
        for a in range(0, max(len(c), 1), BLOCK):
            by_size.setdefault(min(BLOCK, len(c) - a), []).append((i, a))
    solved: dict[tuple[int, int], dict] = {}
    for n, places in by_size.items():
        step = max(1, 4 * BLOCK // (n + 1))
        for k in range(0, len(places), step):
            some = places[k:k + step]
            found = _paths(np.array([codes[i][a:a + n] for i, a in some]).reshape(len(some), n),
                           np.array([costs[i][a:a + n + 1] for i, a in some]),
                           np.array([is_last[i] and a + n == len(codes[i]) for i, a in some]),
                           [[START] if is_first[i] and a == 0 else [0, 1, 2, 3] for i, a in some])
            solved.update(zip(some, found))
    out = []
    for i, c in enumerate(codes):
        ways = {}
        for e in ([START] if is_first[i] else range(4)):
            audit, state = [], e
            for a in range(0, max(len(c), 1), BLOCK):
                letters, state = solved[i, a][state]
                audit.append(letters)
            ways[e] = (b"".join(audit), state)
        out.append((ways, int(costs[i][0][START])))
    return out


SOLVED = "ck string, part int, audits array<binary>, exits array<int>, cost bigint, blank bigint, repeated bigint, cut bigint"


def _solve(batches):
    """Arrow task: (ck, part, codes, behind, is_first, is_last) -> SOLVED; four audits, or one for a first segment."""
    names = [f.split()[0] for f in SOLVED.split(", ")]
    for b in batches:
        if not len(b):
            continue
        codes = [np.frombuffer(c, np.uint8) for c in b.column(2).to_pylist()]
        firsts, lasts = b.column(4).to_pylist(), b.column(5).to_pylist()
        found = solve(codes, b.column(3).to_pylist(), lasts, firsts)
        ways = [[w[e] for e in sorted(w)] for w, _ in found]
        count = lambda fault: pa.array([int((c // 4 == fault).sum()) for c in codes], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([[a for a, _ in w] for w in ways], pa.list_(pa.binary())),
             pa.array([[s for _, s in w] for w in ways], pa.list_(pa.int32())),
             pa.array([c for _, c in found], pa.int64()), count(BLANK), count(REPEATED), count(CUT)], names)


def _chain_on(group: pd.DataFrame) -> pd.DataFrame:
    """The audit of each segment by the state that it is entered in."""
    group = group.sort_values("part")
    state, taken = START, []
    for audits, exits in zip(group["audits"], group["exits"]):
        at = 0 if len(audits) == 1 else state
        taken.append(audits[at])
        state = exits[at]
    return pd.DataFrame({"ck": group["ck"].to_numpy(), "part": group["part"].to_numpy(), "audit": taken,
                         **{c: group[c].to_numpy() for c in ("cost", "blank", "repeated", "cut")}})


AUDIT = "ck string, part int, audit binary, cost bigint, blank bigint, repeated bigint, cut bigint"


def audits(rows: DataFrame) -> DataFrame:
    """AUDIT: the edits of each segment of a conversation, by its place ``part``."""
    order = [F.asc("ck"), *_in_turn(), F.asc("uid")]
    parted = _typed(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    segments = stage(parted.select("ck", F.spark_partition_id().alias("part"), F.col("code").cast("int"))
                     .mapInArrow(_gather, SEGMENT), "segments")
    # conversations in several partitions: at most one row a partition each
    long = stage(segments.groupBy("ck").agg(F.min("part").alias("first"), F.max("part").alias("last"))
                 .where("first < last"), "long")
    tables = segments.join(long, "ck").select("ck", "part", "codes").mapInArrow(
        _tables, "ck string, part int, costs array<bigint>")
    behind = tables.groupBy("ck").applyInPandas(_chain_back, "ck string, part int, behind array<bigint>")
    whole = F.col("first").isNull()
    tasks = segments.join(long, "ck", "left").join(stage(behind, "behind"), ["ck", "part"], "left").select(
        "ck", "part", "codes", "behind", (whole | (F.col("part") == F.col("first"))).alias("is_first"),
        (whole | (F.col("part") == F.col("last"))).alias("is_last"))
    solved = stage(tasks.mapInArrow(_solve, SOLVED), "solved")
    one = solved.join(long, "ck", "left_anti").select(
        "ck", "part", F.col("audits")[0].alias("audit"), "cost", "blank", "repeated", "cut")
    several = solved.join(long, "ck", "left_semi").groupBy("ck").applyInPandas(_chain_on, AUDIT)
    return one.unionByName(several)


def _stream(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Audits, then turns in order, then dropped rows, conversation by conversation."""
    turns = rows.select("ck", "conv_id", F.when(F.col("gone"), 2).otherwise(1).alias("kind"), F.lit(0).alias("part"),
                        "turn", "role", F.md5("text").alias("digest"), F.when(~F.col("gone"), F.col("text")).alias("text"))
    heads = found.withColumns({"kind": F.lit(0)})
    both = turns.unionByName(heads, allowMissingColumns=True)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(n, "ck").sortWithinPartitions("ck", "kind", "part", *_in_turn())
    return both.select("ck", "conv_id", "kind", "turn", "role", "text", "audit", "cost", "blank", "repeated", "cut")


class _Walk:
    """One conversation as it streams by: its audit, its turns in order."""

    def __init__(self):
        self.audit, self.at, self.state = bytearray(), 0, START
        self.cost = self.blank = self.repeated = self.cut = self.illegal = 0
        self.conv_id = self.before = self.least = self.most = None
        self.turns, self.headed = 0, False
        self.sha, self.pieces = hashlib.sha256(), 0

    def head(self, audit, cost, blank, repeated, cut):
        if not self.headed:
            self.cost, self.headed = cost, True
        self.audit += audit
        self.blank, self.repeated, self.cut = self.blank + blank, self.repeated + repeated, self.cut + cut

    def _new_turn(self):
        self.state = int(NEXT[self.state])
        return "user" if self.state == USER else "assistant"

    def inserted(self):
        """The turns inserted before the next one, or at the end."""
        while self.at < len(self.audit) and self.audit[self.at] == ord("I"):
            self.at += 1
            yield "I", None, self._new_turn(), ""

    def turn(self, turn, role, text):
        """(edit, turn, role, text) of what the audit makes of the next turn."""
        if turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        yield from self.inserted()
        edit = chr(self.audit[self.at])
        self.at += 1
        if edit == "K":
            self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[initial]
            yield edit, turn, role, text
        elif edit == "R":
            yield edit, turn, self._new_turn(), text

    def add(self, pieces):
        for _, _, role, text in pieces:
            self.sha.update((("\n" if self.pieces else "") + role + ":" + text).encode())
            self.pieces += 1

    def digest(self):
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.repeated, self.cut, self.illegal, self.cost,
                bytes(self.audit).decode(), self.sha.hexdigest())


def _walks(batches):
    """(walk, what its next row gives, is it over) along a sorted stream."""
    held, walk = None, None
    for b in batches:
        for ck, conv_id, kind, turn, role, text, *head in zip(*(c.to_pylist() for c in b.columns)):
            if ck != held:
                if walk is not None:
                    yield walk, walk.inserted(), True
                held, walk = ck, _Walk()
            if kind == 0:
                walk.head(*head)
                continue
            walk.conv_id = conv_id
            if kind == 1:
                yield walk, walk.turn(turn, role, text), False
    if walk is not None:
        yield walk, walk.inserted(), True


DIGEST = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "cost bigint, audit string, repaired_sha256 string")
REPAIRED = "conv_id bigint, place bigint, edit string, turn bigint, role string, text string"


def _batch(rows, schema: str):
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows), fields)],
                                      [n for n, _ in fields])


def _digests(batches):
    """Arrow task: the sorted stream -> one row a conversation."""
    rows = []
    for walk, pieces, over in _walks(batches):
        walk.add(pieces)
        if over:
            rows.append(walk.digest())
        if len(rows) >= 1000:
            yield _batch(rows, DIGEST)
            rows = []
    if rows:
        yield _batch(rows, DIGEST)


def _turns(batches):
    """Arrow task: the sorted stream -> the turns that remain or are new."""
    rows, size = [], 0
    for walk, pieces, _ in _walks(batches):
        for edit, turn, role, text in pieces:
            rows.append((walk.conv_id, walk.pieces, edit, turn, role, text))
            walk.pieces += 1
            size += len(text) + 50
        if size > 4_000_000:
            yield _batch(rows, REPAIRED)
            rows, size = [], 0
    if rows:
        yield _batch(rows, REPAIRED)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations, a row a turn: (conv_id, place, edit, turn, role, text)."""
    return _stream(rows, audits(rows)).mapInArrow(_turns, REPAIRED)


def digests(rows: DataFrame) -> DataFrame:
    """One row a conversation: its faults, the cost, the audit and the SHA-256 of the repaired form."""
    return _stream(rows, audits(rows)).mapInArrow(_digests, DIGEST)


def op13_repair(spark, sf_dir: str) -> DataFrame:
    """All ``conversations``, damaged as agreed, and their repair."""
    return digests(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
