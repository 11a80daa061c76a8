"""Operator 1: scoring texts with a hidden Markov language model.

Tokens are the text's words (A-Z lower-cased, split at white space) and one end. A state emits a class of words, and the
class a word: words are hashed to CLASSES classes, whose distribution differs by state, and a word's share of its class
is its share of the class's training tokens. A word that no training text has is one more outcome, whose probability in
every state is the share of training tokens that are their word's only one (Good and Turing's estimate). So the
probabilities of all words, the unknown outcome and the end sum to one in each state.

Work is done on blocks of texts of a few MB, written once to the shared folder as local word numbers:
* Counts: each block sends its distinct words' hashes and training counts, in shards of the hash range, to where a shard
  of all blocks is added up; the sums go back to the blocks. A word is sent once per block however frequent it is, and
  shards grow in number with the blocks, so no task gathers more than a share. All training texts are counted.
* Baum-Welch: each pass gives every task the parameters (of fixed size), adds up expected counts per task and then by
  class over all tasks. Passes go over all training tokens; longer texts are learned in runs of RUN tokens. The first
  parameters come from passes over a sample of runs (`sample_tokens` tokens, a parameter), chosen by a hash of the text, so
  scores don't depend on how the table is laid out.
* Scoring: the scaled forward recursion gives the exact likelihood of whole texts. Texts of over PART tokens are cut into
  parts whose recursions run side by side from every state, and are chained afterwards, which is exact too.

A null text is empty and consists of the end. Without training texts all scores are 0 (one outcome is left). Rows that
repeat an id are scored each; an empty table gives no rows. Only the named columns are read. 64-bit hashes stand for
words; among a billion distinct words the chance that any two share one is 3 %.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import blank_null, mix64, pieces, text_bytes, written

STATES, CLASSES = 8, 1 << 15
END = 0  # the end's class; words have the others
RUN, PART, CHUNK = 512, 1024, 200_000
BLOCK_BYTES = 4 << 20
KAPPA = 20.0  # how many tokens of the average state each state is given besides its own


def _raw(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def cells(batch: pa.RecordBatch, **kinds):
    """Row by row, the named binary columns as arrays over the batch's own memory."""
    columns = [(batch.column(c), kind) for c, kind in kinds.items()]
    for i in range(batch.num_rows):
        yield [np.frombuffer(column[i].as_buffer(), kind) for column, kind in columns]


def classes(hashes: np.ndarray, end: int) -> np.ndarray:
    out = (hashes % np.uint64(CLASSES - 1)).astype(np.int32) + 1
    out[hashes == np.uint64(end)] = END
    return out


def end_hash() -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(b"")  # no word is empty


def blocks(docs: DataFrame, id_col: str, text_col: str, learn: Column) -> DataFrame:
    """One row per block of texts: ids, a hash of each id and text, which are learned from, where each text's tokens begin,
    the tokens as numbers of the block's distinct words, and these words' hashes (ascending) and training counts."""
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("i"), blank_null(text_col).alias("t"), F.coalesce(learn, F.lit(False)).alias("l"))
    schema = (f"block long, n_docs int, ids array<{kind}>, key binary, learn binary, begin binary, token binary, hash binary, "
              "seen binary")
    end = end_hash()

    def run(batches):
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        part, number = TaskContext.get().partitionId(), 0
        for piece in pieces(batches, "t", BLOCK_BYTES):
            off, data = text_bytes(piece.column("t"))
            raw = data.tobytes().lower()
            flat: list[bytes] = []
            numbers: dict[bytes, int] = {}
            begin, key, tokens = [0], [], []

            def flush():
                """The words gathered so far as numbers, in the order in which words came up: lists of them are large."""
                for w in dict.fromkeys(flat):
                    if w not in numbers:
                        numbers[w] = len(numbers)
                tokens.append(np.fromiter(map(numbers.__getitem__, flat), np.int32, len(flat)))
                flat.clear()

            ids = piece.column("i").to_pylist()
            for i, a, b in zip(ids, off[:-1].tolist(), off[1:].tolist(), strict=True):
                text = raw[a:b]
                key.append(digest(text, seed=zlib.crc32(str(i).encode())))
                before = len(flat)
                flat += text.split()
                flat.append(b"")
                begin.append(begin[-1] + len(flat) - before)
                if len(flat) > 50_000:
                    flush()
            flush()
            words = list(numbers)
            hashes = np.fromiter(map(digest, words), np.uint64, len(words))
            order = np.argsort(hashes)
            rank = np.empty(len(words), np.int32)
            rank[order] = np.arange(len(words), dtype=np.int32)
            token = rank[np.concatenate(tokens)]
            learn_ = np.array(piece.column("l").to_pylist(), bool)
            size = np.diff(begin)
            seen = np.bincount(token[np.repeat(learn_, size)], minlength=len(words)).astype(np.int32)
            row = [[part << 32 | number], [piece.num_rows], [ids], [_raw(np.array(key, np.uint64))], [_raw(learn_)],
                   [_raw(np.array(begin, np.int64))], [_raw(token)], [_raw(hashes[order])], [_raw(seen)]]
            kinds = [pa.int64(), pa.int32(), pa.list_(piece.column("i").type), *[pa.binary()] * 6]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)],
                                             names=["block", "n_docs", "ids", "key", "learn", "begin", "token", "hash", "seen"])
            number += 1

    return base.mapInArrow(run, schema)


def word_counts(table: DataFrame, n_blocks: int) -> DataFrame:
    """(block, shard, count): the training counts over all blocks of the words of a block in a shard, in the order of
    the block's hashes; and in rows with a null block, each shard's numbers of words, of words seen once, and tokens."""
    bits = max(4, (n_blocks - 1).bit_length())

    def split(batches):
        for batch in batches:
            for block, (h, s) in zip(batch.column("block").to_pylist(), cells(batch, hash=np.uint64, seen=np.int32), strict=True):
                shard = (h >> np.uint64(64 - bits)).astype(np.int32)
                cut = np.flatnonzero(np.diff(shard, prepend=-1, append=-1) != 0) if len(shard) else np.zeros(0, np.int64)
                spans = list(zip(cut[:-1].tolist(), [*cut[1:-1].tolist(), len(h)], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(shard[a]) for a, _ in spans], pa.int32()), pa.array([block] * len(spans), pa.int64()),
                     pa.array([_raw(h[a:b]) for a, b in spans], pa.binary()),
                     pa.array([_raw(s[a:b]) for a, b in spans], pa.binary())], names=["shard", "block", "hash", "seen"])

    def merge(group: pa.Table) -> pa.Table:
        block = group.column("block").to_pylist()
        hashes = [np.frombuffer(x, np.uint64) for x in group.column("hash").to_pylist()]
        seen = np.concatenate([np.frombuffer(x, np.int32) for x in group.column("seen").to_pylist()])
        _, which = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(which, weights=seen).astype(np.int64)
        back = total[which]
        edge = np.cumsum([0, *map(len, hashes)])
        n = len(block)
        return pa.table({
            "block": pa.array([*block, None], pa.int64()), "shard": pa.array([group.column("shard")[0].as_py()] * (n + 1), pa.int32()),
            "count": pa.array([*(_raw(back[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)), None], pa.binary()),
            "words": pa.array([None] * n + [int((total > 0).sum())], pa.int64()),
            "once": pa.array([None] * n + [int((total == 1).sum())], pa.int64()),
            "tokens": pa.array([None] * n + [int(total.sum())], pa.int64())})

    pieces_ = table.select("block", "hash", "seen").mapInArrow(split, "shard int, block long, hash binary, seen binary")
    return pieces_.groupBy("shard").applyInArrow(merge, "block long, shard int, count binary, words long, once long, tokens long")


class Parameters:
    """Start, transition and emission probabilities: numbers of a fixed size."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, anywhere: np.ndarray):
        self.start, self.move, self.emit, self.anywhere = start, move, emit, anywhere

    def arrays(self) -> tuple:
        return self.start, self.move, self.emit, self.anywhere

    @classmethod
    def of_counts(cls, start, move, emit, anywhere, floor: float = 0.0) -> Parameters:
        """Maximum likelihood with a few tokens of the average state, so that no state lacks a class that others have.
        floor: for classes that only a sample lacks."""
        share = (emit.sum(axis=1) + floor) / (emit.sum() + floor * len(emit))
        return cls((start + 1) / (start + 1).sum(), (move + 1) / (move + 1).sum(axis=1, keepdims=True),
                   (emit + KAPPA * share[:, None]) / (emit.sum(axis=0) + KAPPA), (anywhere + 1) / (anywhere + 1).sum())


class Expected:
    """Expected counts of one Baum-Welch pass, and the log likelihood."""

    def __init__(self):
        self.start, self.move = np.zeros(STATES), np.zeros((STATES, STATES))
        self.emit, self.anywhere, self.log = np.zeros((CLASSES, STATES)), np.zeros(STATES), 0.0

    def add(self, p: Parameters, obs: np.ndarray, begin: np.ndarray, size: np.ndarray, first: np.ndarray) -> None:
        """Runs of tokens obs[begin : begin + size]; first: those that begin a text."""
        order = np.argsort(-size, kind="stable")
        edge = 0
        while edge < len(order):
            upto = edge + max(1, int(np.searchsorted(np.cumsum(size[order[edge:]]), CHUNK, side="right")))
            some = order[edge:upto]
            self._add(p, obs, begin[some], size[some], first[some])
            edge = upto

    def _add(self, p, obs, begin, size, first) -> None:
        emit, move = p.emit.astype(np.float32), p.move.astype(np.float32)
        active = [int(n) for n in len(size) - np.searchsorted(size[::-1], np.arange(size[0]), side="right")]
        alphas, seen, scales = [], [], []
        alpha = np.where(first[:, None], p.start, p.anywhere).astype(np.float32)
        for t, n in enumerate(active):
            o = obs[begin[:n] + t]
            b = emit[o]
            alpha = (alpha[:n] @ move if t else alpha) * b
            scale = alpha.sum(axis=1, keepdims=True)
            alpha /= scale
            alphas.append(alpha)
            seen.append((o, b))
            scales.append(scale)
            self.log += float(np.log(scale, dtype=np.float64).sum())
        gammas = [None] * len(active)
        beta = np.ones((active[-1], STATES), np.float32)
        moved = np.zeros((STATES, STATES))
        for t in range(len(active) - 1, -1, -1):
            gamma = alphas[t] * beta
            gammas[t] = gamma
            if t:
                back = beta * seen[t][1] / scales[t]
                moved += alphas[t - 1][: len(back)].T @ back
                before = np.ones((active[t - 1], STATES), np.float32)
                before[: len(back)] = back @ move.T
                beta = before
        self.move += moved * p.move
        self.start += gammas[0][first].sum(axis=0)
        gamma = np.concatenate(gammas)
        o = np.concatenate([x for x, _ in seen])
        for k in range(STATES):
            self.emit[:, k] += np.bincount(o, weights=gamma[:, k], minlength=CLASSES)
        self.anywhere += gamma.sum(axis=0)

    def parameters(self) -> Parameters:
        return Parameters.of_counts(self.start, self.move, self.emit, self.anywhere, floor=0.5)


def runs(begin: np.ndarray, which: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The chosen texts cut into runs: begin, size, whether a run begins its text, and the text."""
    size = np.diff(begin)[which]
    n = -(-size // longest)
    text = np.repeat(which, n)
    place = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    start = begin[:-1][text] + place * longest
    return start, np.minimum(longest, begin[1:][text] - start), place == 0, text


def first_parameters(table: DataFrame, tokens: int, sample_tokens: int, passes: int) -> Parameters:
    """Baum-Welch from random emissions on a bounded sample: runs of training texts in the order of a hash of id, text and
    place, up to sample_tokens, whatever the blocks. It is fitted in one task. All data are passed over afterwards."""
    end = end_hash()
    share = min(1.0, 1.5 * sample_tokens / max(tokens, 1))
    limit = np.uint64(min(int(share * 2.0**64), 2**64 - 1))

    def sample(batches):
        for batch in batches:
            for begin, token, hashes, learn, key in cells(batch, begin=np.int64, token=np.int32, hash=np.uint64, learn=bool, key=np.uint64):
                start, size, first, text = runs(begin, np.flatnonzero(learn), RUN)
                with np.errstate(over="ignore"):
                    h = mix64(key[text] + (start - begin[:-1][text]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                some = np.flatnonzero(h <= limit)
                obs = classes(hashes, end)[token]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[some].view(np.int64)), pa.array(first[some]),
                     pa.array([_raw(obs[a : a + n]) for a, n in zip(start[some].tolist(), size[some].tolist(), strict=True)], pa.binary())], names=["h", "first", "obs"])

    def fit(batches):
        rows = [(h % 2**64, first, obs) for b in batches for h, first, obs in zip(*(b.column(c).to_pylist() for c in ("h", "first", "obs")), strict=True)]
        rows.sort()
        size = np.fromiter((len(r[2]) // 4 for r in rows), np.int64, len(rows))
        n = int(np.searchsorted(np.cumsum(size), sample_tokens, side="right"))
        obs = np.frombuffer(b"".join(r[2] for r in rows[:n]), np.int32)
        size, first = size[:n], np.fromiter((r[1] for r in rows[:n]), bool, n)
        rnd = np.random.default_rng(20_240_601)
        share = (np.bincount(obs, minlength=CLASSES) + 0.5) / (len(obs) + 0.5 * CLASSES)
        emit = share[:, None] * rnd.gamma(2.0, size=(CLASSES, STATES))
        move = np.full((STATES, STATES), 0.1 / STATES) + 0.9 * np.eye(STATES)
        even = np.full(STATES, 1 / STATES)
        p = Parameters(even, move, emit / emit.sum(axis=0), even)
        begin = np.cumsum(size) - size
        for _ in range(passes if len(obs) else 0):
            e = Expected()
            e.add(p, obs, begin, size, first)
            p = e.parameters()
        yield pa.RecordBatch.from_arrays([pa.array([_raw(x.astype(np.float64))], pa.binary()) for x in p.arrays()], names=names)

    names = ["start", "move", "emit", "anywhere"]
    # some runs over sample_tokens, of four bytes a token, in the one task
    picked = table.select("begin", "token", "hash", "learn", "key").mapInArrow(sample, "h long, first boolean, obs binary").repartition(1)
    row = picked.mapInArrow(fit, ", ".join(f"{n} binary" for n in names)).first()
    shapes = ((STATES,), (STATES, STATES), (CLASSES, STATES), (STATES,))
    return Parameters(*(np.frombuffer(row[n], np.float64).reshape(x) for n, x in zip(names, shapes, strict=True)))


def baum_welch(table: DataFrame, p: Parameters) -> tuple[Parameters, np.ndarray, float]:
    """One pass over all training tokens: the next parameters, the training tokens of each class, the log likelihood."""
    end = end_hash()
    shared = table.sparkSession.sparkContext.broadcast(p.arrays())
    extra = STATES + 3  # rows for transitions, starts, places and the log likelihood follow those of the classes
    names = [f"e{k}" for k in range(STATES)]

    def run(batches):
        e, now = Expected(), Parameters(*shared.value)
        for batch in batches:
            for begin, token, hashes, learn in cells(batch, begin=np.int64, token=np.int32, hash=np.uint64, learn=bool):
                obs = classes(hashes, end)[token]
                start, size, first, _ = runs(begin, np.flatnonzero(learn), RUN)
                if len(start):
                    e.add(now, obs, start, size, first)
        rows = np.concatenate([e.emit, e.move, e.start[None], e.anywhere[None], np.full((1, STATES), e.log)])
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *(pa.array(rows[used, k]) for k in range(STATES))],
                                         names=["row", *names])

    sums = (table.select("begin", "token", "hash", "learn").mapInArrow(run, "row int, " + ", ".join(f"{n} double" for n in names))
            .groupBy("row").agg(*(F.sum(n).alias(n) for n in names)))
    total = np.zeros((CLASSES + extra, STATES))
    for r in sums.toPandas().itertuples(index=False):  # at most CLASSES + extra rows
        total[r[0]] = r[1:]
    emit, move = total[:CLASSES], total[CLASSES : CLASSES + STATES]
    start, anywhere, log = total[CLASSES + STATES], total[CLASSES + STATES + 1], total[-1, 0]
    return Parameters.of_counts(start, move, emit, anywhere), np.rint(emit.sum(axis=1)), float(log)


class Model:
    """Parameters with the totals that turn word counts into probabilities."""

    def __init__(self, p: Parameters, class_tokens: np.ndarray, words: int, once: int, tokens: int):
        self.p, self.class_tokens, self.words, self.tokens = p, class_tokens, words, tokens
        self.unknown = max(once, 0.5) / (tokens + 1) if tokens else 1.0

    def base(self, count: np.ndarray) -> np.ndarray:
        """log10 of the words' smoothed shares of all training tokens."""
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.words + 1)))

    def within(self, count: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """log10 of a known word's share of its class times that of known words, or of the unknown outcome."""
        if not self.tokens:
            return np.zeros(len(count))
        known = np.log10(np.maximum(count, 1) / np.maximum(self.class_tokens[cls], 1)) + math.log10(1 - self.unknown)
        return np.where(count > 0, known, math.log10(self.unknown))

    def forward(self, obs: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """log10 likelihood of each text's classes (CLASSES stands for the unknown outcome, which all states emit alike)."""
        if not self.tokens:  # one outcome is left
            return np.zeros(len(begin) - 1)
        emit = np.vstack([self.p.emit, np.ones(STATES)])
        start, size, first, text = runs(begin, np.arange(len(begin) - 1), PART)
        out = np.zeros(len(begin) - 1)
        order = np.argsort(-size, kind="stable")
        last, log = np.zeros((len(size), STATES, STATES)), np.zeros((len(size), STATES))
        edge = 0
        while edge < len(order):
            upto = edge + max(1, int(np.searchsorted(np.cumsum(size[order[edge:]] * np.where(first[order[edge:]], 1, STATES)), CHUNK, side="right")))
            some = order[edge:upto]
            # one row for a text's first part, and one for each state before a later part
            rows = np.repeat(np.arange(len(some)), np.where(first[some], 1, STATES))
            origin = np.arange(len(rows)) - np.searchsorted(rows, rows)
            a, n = start[some][rows], size[some][rows]
            alpha = np.where(first[some][rows][:, None], self.p.start, self.p.move[origin])
            scale = np.zeros(len(rows))
            kept = np.zeros((len(rows), STATES))
            active = len(n) - np.searchsorted(n[::-1], np.arange(n[0]), side="right")
            for t, live in enumerate(active.tolist()):
                if t:
                    if live < len(alpha):
                        kept[live : len(alpha)] = alpha[live:]
                    alpha = alpha[:live] @ self.p.move
                alpha = alpha * emit[obs[a[:live] + t]]
                s = alpha.sum(axis=1)
                alpha /= s[:, None]
                scale[:live] += np.log(s)
            kept[: len(alpha)] = alpha
            last[some[rows], origin], log[some[rows], origin] = kept, scale
            edge = upto
        one = first & (np.bincount(text, minlength=len(out))[text] == 1)
        out[text[one]] = log[one, 0]
        for i in np.flatnonzero(~one):  # chain the parts of long texts, in order
            if first[i]:
                state, total = last[i, 0], log[i, 0]
            else:
                top = log[i].max()
                state = (state * np.exp(log[i] - top)) @ last[i]
                norm = state.sum()
                state, total = state / norm, total + top + math.log(norm)
            out[text[i]] = total
        return out / math.log(10)


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", passes: int = 3,
          sample_tokens: int = 500_000, sample_passes: int = 25) -> DataFrame:
    """One row per row of docs: id, n_tokens, n_known (tokens with a training count), train_tokens, base_score and score
    (log10 probabilities of the whole text, by the words' shares and by the model)."""
    table = written(blocks(docs, id_col, text_col, learn), "hmm_blocks")
    n_blocks = table.count()
    counts = written(word_counts(table, max(1, n_blocks)), "hmm_counts")
    of_all = counts.where("block IS NULL").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("words", "once", "tokens"))).first()
    p, class_tokens = first_parameters(table, of_all["tokens"], sample_tokens, sample_passes), np.zeros(CLASSES)
    for _ in range(passes if of_all["tokens"] else 0):
        p, class_tokens, _ = baum_welch(table, p)
    model = table.sparkSession.sparkContext.broadcast((p.arrays(), class_tokens, of_all["words"], of_all["once"], of_all["tokens"]))
    end = end_hash()
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")

    def run(batches):
        m = Model(Parameters(*model.value[0]), *model.value[1:])
        for batch in batches:
            for i, (begin, token, hashes) in enumerate(cells(batch, begin=np.int64, token=np.int32, hash=np.uint64)):
                parts = sorted(batch.column("parts")[i].as_py(), key=lambda x: x["shard"])
                count = np.concatenate([np.frombuffer(x["count"], np.int64) for x in parts])
                cls = classes(hashes, end)
                base = np.add.reduceat(m.base(count)[token], begin[:-1])
                within = np.add.reduceat(m.within(count, cls)[token], begin[:-1])
                obs = np.where(count > 0, cls, CLASSES).astype(np.int32)[token]
                known = np.add.reduceat((count > 0)[token].astype(np.int64), begin[:-1])
                n = len(begin) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, pa.array(np.diff(begin)), pa.array(known),
                     pa.array(np.full(n, m.tokens, np.int64)), pa.array(base), pa.array(m.forward(obs, begin) + within)],
                    names=[id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    parts = counts.where("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("shard", "count")).alias("parts"))
    return table.select("block", "ids", "begin", "token", "hash").join(parts, "block").mapInArrow(run, schema)
