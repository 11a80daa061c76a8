"""Operator 13: repair of conversation structure with the fewest edits, reconstructed by Hirschberg's method.

A conversation's rows are taken by turn (nulls first; rows of one turn by the MD5 of role, a zero and text, so that copies
are adjacent). A row's first fault counts: `blank` (no character but white space), `duplicate` (role and text seen
earlier), `truncated` (its last such character is none of . ! ?). Edits: keep (K, 0), re-role to user or assistant (R, 3),
delete (D, 4; blank and duplicate rows must go), insert an empty-text user or assistant row (I, 3); a truncated row that
stays adds 3. The initials of the repaired roles are `(s?(ua)+)?`: four states (nothing yet; after s; after u; after a).

1. Cells. Rows become one narrow cell per (conversation, turn, digest of role and text) with a count, combined in the
   tasks before the shuffle, so a row that is repeated a million times is one cell. First occurrences are the least turns
   by digest.
2. Range-sorted cells become pieces: a byte per row (state of fault and initial). A conversation with a third of all rows
   is sorted by many tasks, and only its bytes meet, which are no more than its audit holds.
3. Hirschberg: a forward vector of four costs from the start state over the first half and a backward vector to the end
   state over the second meet mid-conversation. The crossing with the least sum is chosen, of several the one with the
   ASCII-least audit, and both halves are solved likewise. A row's part of an audit (I, II or nothing, then K, R or D) is
   never the beginning of another, so audits up to the crossing differ and their order settles that of whole audits; the
   forward vector carries that order beside the costs. Vectors have few distinct values but for a constant, so steps are
   looked up. Space is linear, and no table of costs by row is kept.
4. Texts stream past their audit, sorted by conversation, into one running SHA-256: a digest has to be taken in order, so
   a conversation passes through one task, but only a batch of it is held.

Null role and text count as one blank; so do a null id and turn where `damaged` hashes them. A null conversation id is a
conversation of its own; null turns come first and count neither as turns nor gaps. A role whose initial isn't s, u or a
(or that is empty) can't be kept. A conversation without rows has zeros, an empty audit and the digest of the empty
string. Repeated rows are duplicates. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import written

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
INF = 1 << 40
#: By state (0 nothing, 1 after s, 2 after u, 3 after a): what an inserted or re-roled row becomes, and the state after it.
FORCED = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
INITIALS = "sua"
#: What completes a conversation that ends in a state.
TAIL = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
#: A row's code: its initial (0 s, 1 u, 2 a, 3 other) + 4 if truncated + 8 if it must go.
CODES = 12
#: Rows of a conversation in one piece.
PIECE_ROWS = 100_000


def moves(code: int) -> list[dict[int, tuple[int, str]]]:
    """By state before a row: the states after it with cost and audit of the best way there."""
    out: list[dict[int, tuple[int, str]]] = []
    for state in range(4):
        ways: dict[int, tuple[int, str]] = {state: (DELETE, "D")}  # rows inserted before a deleted one go after it instead
        if code < 8:
            at, cost, audit = state, CUT * (code >= 4), ""
            for _ in range(3):  # a third inserted row would lead back to an earlier state
                found = [(FORCED[at][1], cost + REROLE, audit + "R")]
                initial = code % 4
                if initial == 0 and at == 0:
                    found.append((1, cost + KEEP, audit + "K"))
                elif initial < 3 and FORCED[at][0][0] == INITIALS[initial]:
                    found.append((FORCED[at][1], cost + KEEP, audit + "K"))
                for to, c, a in found:
                    ways[to] = min(ways.get(to, (INF, "")), (c, a))
                at, cost, audit = FORCED[at][1], cost + INSERT, audit + "I"
        out.append(ways)
    return out


MOVES = [moves(code) for code in range(CODES)]


def forward_step(vector: tuple, code: int) -> tuple[int, tuple]:
    """vector: by state the cost over the least one, and the place of its audit among the states'. The least cost
    afterwards, and the new vector."""
    best: list[tuple] = [(INF, 0, "")] * 4
    for state, (cost, place) in enumerate(vector):
        if cost < INF:
            for to, (more, audit) in MOVES[code][state].items():
                best[to] = min(best[to], (cost + more, place, audit))
    least = min(b[0] for b in best)
    order = sorted(range(4), key=lambda s: best[s][1:])
    return least, tuple((best[s][0] - least if best[s][0] < INF else INF, order.index(s)) for s in range(4))


def backward_step(vector: tuple, code: int) -> tuple[int, tuple]:
    """The same from behind, costs only."""
    best = [min((cost + vector[to] for to, (cost, _) in MOVES[code][s].items() if vector[to] < INF), default=INF) for s in range(4)]
    least = min(best)
    return least, tuple(b - least if b < INF else INF for b in best)


def crossing(ahead: tuple, behind: list | tuple) -> int:
    """The state where a forward and a backward vector meet at the least cost; of several the one with the least audit."""
    return min(range(4), key=lambda s: (ahead[s][0] + behind[s], ahead[s][1]))


class Repairer:
    """Hirschberg's method on row codes. Steps that were made before are looked up, and so are short conversations."""

    SHORT, KNOWN = 32, 1 << 15

    def __init__(self):
        self.steps: tuple[dict, dict] = ({}, {})
        self.short: dict[bytes, tuple[int, str]] = {}

    def _step(self, way: int, vector: tuple, code: int) -> tuple[int, tuple]:
        known = self.steps[way]
        out = known.get((vector, code))
        if out is None:
            if len(known) >= self.KNOWN:
                known.clear()
            out = known[vector, code] = (forward_step, backward_step)[way](vector, code)
        return out

    def forward(self, rows: bytes, lo: int, hi: int, start: int) -> tuple[int, tuple]:
        base, vector = 0, tuple((0 if s == start else INF, s) for s in range(4))
        for code in rows[lo:hi]:
            least, vector = self._step(0, vector, code)
            base += least
        return base, vector

    def backward(self, rows: bytes, lo: int, hi: int, end: int) -> tuple:
        vector = tuple(0 if s == end else INF for s in range(4))
        for code in reversed(rows[lo:hi]):
            _, vector = self._step(1, vector, code)
        return vector

    def between(self, rows: bytes, start: int, end: int) -> str:
        """The least of the cheapest audits from state to state."""
        out: list[str] = []
        todo = [(0, len(rows), start, end)]
        while todo:
            lo, hi, a, b = todo.pop()
            if hi - lo == 1:
                out.append(MOVES[rows[lo]][a][b][1])
                continue
            mid = (lo + hi) // 2
            state = crossing(self.forward(rows, lo, mid, a)[1], self.backward(rows, mid, hi, b))
            todo += [(mid, hi, state, b), (lo, mid, a, state)]
        return "".join(out)

    def repair(self, rows: bytes) -> tuple[int, str]:
        """Cost and audit of the cheapest repair of a conversation's row codes."""
        if not rows:
            return 0, ""
        found = self.short.get(rows)
        if found is None:
            base, ahead = self.forward(rows, 0, len(rows), 0)
            end = crossing(ahead, [c for c, _ in TAIL])
            found = base + ahead[end][0] + TAIL[end][0], self.between(rows, 0, end) + TAIL[end][1]
            if len(rows) <= self.SHORT and len(self.short) < self.KNOWN:
                self.short[rows] = found
        return found


def illegal_pairs(rows: bytes) -> int:
    """Adjacent rows whose initials are not su, ua or au."""
    return sum((a % 4, b % 4) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(rows, rows[1:], strict=False))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with the faults that the query plants, by crc32(`conv_id:turn`) mod 20; a dropped row stays as a row
    whose `copies` is 0, so that its conversation is known."""
    h = F.expr("crc32(cast(concat(coalesce(cast(conv_id AS STRING), ' '), ':', coalesce(cast(turn AS STRING), ' ')) AS binary)) % 20")
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return (rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"), h.alias("h"))
            .select("conv_id", "turn",
                    F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.expr("CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END").alias("text"),
                    F.expr("CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END").alias("copies")))


def whole(rows: DataFrame) -> DataFrame:
    """Conversations as they are, in the form that `repaired` takes."""
    return rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


def _keyed(rows: DataFrame) -> DataFrame:
    digest = F.expr("unhex(md5(concat(role, '\\0', text)))")
    return rows.select(F.col("conv_id").alias("c"), F.col("turn").cast("long").alias("t"), "role", "text", "copies", digest.alias("d"))


def _cells(keyed: DataFrame) -> DataFrame:
    """(c, t, d, m, code, blank, first): m equal rows of a turn; `first`: none of them was seen earlier."""
    last = F.expr("right(rtrim(' \\t\\n\\u000B\\u000C\\r', text), 1)")  # rtrim takes the characters to trim first
    initial = F.expr("CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END")
    marked = (keyed.where("copies > 0").withColumn("z", last)
              .select("c", "t", "d", "copies", initial.alias("initial"), (F.col("z") == "").alias("blank"), (~F.col("z").isin(".", "!", "?")).alias("cut")))
    cells = marked.groupBy("c", "t", "d", "initial", "blank", "cut").agg(F.sum("copies").cast("long").alias("m"))
    cells = written(cells, "conversation_cells")
    least = F.min(F.struct(F.col("t").isNotNull().alias("x"), F.col("t").alias("y"))).alias("least")
    firsts = cells.where("NOT blank").groupBy("c", "d").agg(least).select(F.col("c").alias("fc"), F.col("d").alias("fd"), "least.y", F.lit(True).alias("first"))
    same = F.col("c").eqNullSafe(F.col("fc")) & (F.col("d") == F.col("fd")) & F.col("t").eqNullSafe(F.col("y"))
    return cells.join(firsts, same, "left").select("c", "t", "d", "m", "initial", "blank", "cut", F.coalesce("first", F.lit(False)).alias("first"))


def _pieces(cells: DataFrame, kind: str) -> DataFrame:
    """(c, at, rows, counts of faults, low, high, turns): stretches of conversations in order, from cells sorted over all tasks
    by range."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        here, opened, number = None, False, 0
        piece: dict = {}

        def fresh():
            return {"rows": bytearray(), "blank": 0, "duplicate": 0, "truncated": 0, "low": None, "high": None, "turns": 0}

        def out(done):
            cols = [pa.array([here], c_type), pa.array([(part << 32) + number], pa.int64()), pa.array([bytes(done["rows"])], pa.binary())]
            cols += [pa.array([done[x]], pa.int64()) for x in names[3:]]
            return pa.RecordBatch.from_arrays(cols, names=names)

        names = ["c", "at", "rows", "blank", "duplicate", "truncated", "low", "high", "turns"]
        for batch in batches:
            c_type = batch.column("c").type
            columns = [batch.column(x).to_pylist() for x in ("c", "t", "m", "initial", "blank", "cut", "first")]
            for c, t, m, initial, blank, cut, first in zip(*columns, strict=True):
                if opened and (c != here or len(piece["rows"]) >= PIECE_ROWS):
                    yield out(piece)
                    opened, number = False, number + 1
                if not opened:
                    here, opened, piece = c, True, fresh()
                if t is not None and t != piece["high"]:
                    piece["low"] = t if piece["low"] is None else piece["low"]
                    piece["high"] = t
                    piece["turns"] += 1
                if blank:
                    piece["blank"] += m
                    piece["rows"] += bytes([initial + 8]) * m
                else:
                    stays = int(first)
                    piece["duplicate"] += m - stays
                    piece["truncated"] += stays * cut
                    piece["rows"] += bytes([initial + 4 * cut]) * stays + bytes([initial + 8]) * (m - stays)
        if opened:
            yield out(piece)

    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = cells.repartitionByRange(n, F.col("c").asc_nulls_first(), F.col("t").asc_nulls_first(), "d")
    ordered = ordered.sortWithinPartitions(F.col("c").asc_nulls_first(), F.col("t").asc_nulls_first(), "d")
    return ordered.select("c", "t", "m", "initial", "blank", "cut", "first").mapInArrow(
        run, f"c {kind}, at long, rows binary, blank long, duplicate long, truncated long, low long, high long, turns long")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _audits(pieces: DataFrame, kind: str) -> DataFrame:
    """(c, COUNTS, audit) of each conversation with rows."""
    listed = pieces.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("at", "rows", "blank", "duplicate", "truncated", "low", "high", "turns"))).alias("p"))

    def run(batches):
        repairer = Repairer()
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                some = batch.slice(start, 2000)
                found = []
                for parts in some.column("p").to_pylist():
                    rows = b"".join(p["rows"] for p in parts)
                    timed = [p for p in parts if p["low"] is not None]
                    gaps = 0
                    if timed:  # a turn may span two pieces
                        shared = sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:], strict=False))
                        gaps = timed[-1]["high"] - timed[0]["low"] + 1 - (sum(p["turns"] for p in timed) - shared)
                    cost, audit = repairer.repair(rows)
                    found.append((gaps, *(sum(p[x] for p in parts) for x in ("blank", "duplicate", "truncated")), illegal_pairs(rows), cost, audit))
                *numbers, audits = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([some.column("c"), *(pa.array(x, pa.int64()) for x in numbers), pa.array(audits, pa.string())],
                                                 names=["c", *COUNTS, "audit"])

    return listed.select("c", "p").mapInArrow(run, f"c {kind}, " + ", ".join(f"{x} long" for x in COUNTS) + ", audit string")


class Rebuilt:
    """Rows of one conversation, one after another, as its audit says."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role, self.state = FORCED[self.state]
            self.at += 1
            yield role, ""

    def row(self, role: str, text: str):
        """The repaired rows up to and with this one."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        if edit == "R":
            role, self.state = FORCED[self.state]
        else:
            self.state = 1 if role[0] == "s" else FORCED[self.state][1]
        yield role, text


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text, copies): conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256 (of the repaired `role:text`, newline-joined)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    keyed = _keyed(rows)
    audits = written(_audits(written(_pieces(_cells(keyed), kind), "conversation_pieces"), kind), "conversation_audits")
    # tag 0: the audit; 1: rows in order; 2: a dropped row, which only says that there is such a conversation
    texts = keyed.select("c", F.expr("CASE WHEN copies > 0 THEN 1 ELSE 2 END").alias("tag"), "t", "d", "copies",
                         F.expr("CASE WHEN copies > 0 THEN role END").alias("role"), F.expr("CASE WHEN copies > 0 THEN text END").alias("text"))
    blank = [F.lit(None).cast("long").alias(x) for x in COUNTS]
    heads = audits.select("c", F.lit(0).alias("tag"), F.lit(None).cast("long").alias("t"), F.lit(None).cast("binary").alias("d"),
                          F.lit(0).alias("copies"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"), *COUNTS)
    both = heads.unionByName(texts.select("*", *blank))
    ordered = both.repartition("c").sortWithinPartitions(F.col("c").asc_nulls_first(), "tag", F.col("t").asc_nulls_first(), "d")

    def run(batches):
        names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
        here, opened, state = None, False, None
        done: list[tuple] = []

        def feed(new):
            for role, text in new:
                state["sha"].update((("\n" if state["any"] else "") + f"{role}:{text}").encode())
                state["any"] = True

        def close():
            feed(state["rebuilt"].inserted())
            done.append((here, *state["counts"], state["rebuilt"].audit, state["sha"].hexdigest()))

        def out():
            ids, *numbers, audits_, shas = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(ids, c_type), *(pa.array(x, pa.int64()) for x in numbers), pa.array(audits_, pa.string()),
                                               pa.array(shas, pa.string())], names=names)

        for batch in batches:
            c_type = batch.column("c").type
            columns = [batch.column(x).to_pylist() for x in ("c", "tag", "copies", "role", "text")]
            counts = list(zip(*(batch.column(x).to_pylist() for x in COUNTS), strict=True))
            for i, (c, tag, copies, role, text) in enumerate(zip(*columns, strict=True)):
                if opened and c != here:
                    close()
                    opened = False
                if not opened:
                    here, opened = c, True
                    state = {"sha": hashlib.sha256(), "any": False, "rebuilt": Rebuilt(""), "counts": [0] * len(COUNTS)}
                if tag == 0:
                    state["rebuilt"], state["counts"] = Rebuilt(text), counts[i]
                elif tag == 1:
                    for _ in range(copies):
                        feed(state["rebuilt"].row(role, text))
            if len(done) >= 1000:
                yield out()
                done.clear()
        if opened:
            close()
        if done:
            yield out()

    cols = ["c", "tag", "copies", "role", "text", *COUNTS]
    return ordered.select(cols).mapInArrow(run, f"conv_id {kind}, " + ", ".join(f"{x} long" for x in COUNTS) + ", audit string, repaired_sha256 string")
