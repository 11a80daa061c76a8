"""Operator 9: near-duplicate documents by MinHash signatures and a multi-index Hamming join, confirmed on full sets.

A document's set is its distinct shingles of `words` words (A-Z lower-cased, split at white space; a text of fewer words
is one shingle). Documents of Jaccard similarity `percent` % or more are linked, and components of links are classes.

1. Equal sets are one node from here on. A node has POSITIONS min-hashes of 16 bits.
2. Multi-index: signatures are split into CHUNKS chunks of WIDTH positions. Of two signatures that differ in at most
   2 * CHUNKS - 1 positions, one chunk differs in at most one (pigeonhole), so each chunk is indexed with each of its
   positions left out. At a similarity of 0.8 a pair differs in more positions with a probability of 2e-6. Nodes that
   share an index key are tied where the lowest bits of their signatures are near enough (SKETCH_LIMIT of SKETCH bits;
   a pair at 0.8 exceeds it with a probability of 1e-5, unrelated texts pass it in 5e-6).
   Keys go to shards as packed arrays; a key's nodes are compared as bit arrays in its task, and give one tie per node,
   never all pairs. Keys that hold over HOT nodes by a sample are dealt to several shards: see `_hot`.
3. Tied nodes form candidate clusters. Each node's full set is sent to its cluster's task once, where links are
   confirmed exactly. A cluster of more than BLOCK nodes is dealt to blocks that share some nodes, which joins most of what
   belongs together.
4. Links of large clusters between different classes of step 3, as among texts of one template, are found by a prefix filter
   on the full sets: shingles are ordered by how often they occur (counters of a fixed size), rarest first, and two sets at
   `percent` share one of their first n - ceil(percent * n) + 1. Nodes meet by these shingles; what two prefixes have in
   common bounds the similarity, and the few pairs that pass are confirmed. Nodes with a prefix shingle that more than
   HOT_SHINGLE nodes have are compared in pairs of blocks instead. No task gathers more than two blocks, and nothing is
   left out.

Null texts and texts without words have the empty set, are linked with nothing and are their own component. Rows that
repeat an id are documents of their own; the component id is the least id (null ids count as no id). An empty table
gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import blank_null, mix64, pieces, text_bytes, written
from carelens.llm.components import components

CHUNKS, WIDTH = 20, 5
POSITIONS = CHUNKS * WIDTH
SKETCH, SKETCH_LIMIT = 96, 24
SHARD_ROWS = 400_000
HOT = 100_000
BLOCK, SHARED = 4000, 64
COUNTERS, HOT_SHINGLE = 1 << 18, 2000
#: Bytes of text whose sets a task makes at once.
PIECE = 512 << 10


def shingle_sets(raw: bytes, off: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, one text after another, and where each text's begin."""
    import xxhash

    flat: list[bytes] = []
    begin = [0]
    raw = raw.lower()
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        flat += raw[a:b].split()
        begin.append(len(flat))
    distinct = list(dict.fromkeys(flat))
    digest = xxhash.xxh3_64_intdigest
    number = dict(zip(distinct, map(digest, distinct), strict=True))
    h = np.fromiter(map(number.__getitem__, flat), np.uint64, len(flat))
    start = np.array(begin, np.int64)
    size = np.diff(start)
    count = np.where(size >= words, size - words + 1, (size > 0).astype(np.int64))
    edge = np.concatenate([[0], np.cumsum(count)])
    text = np.repeat(np.arange(len(size)), count)
    at = start[:-1][text] + np.arange(len(text)) - edge[:-1][text]
    with np.errstate(over="ignore"):
        code = np.zeros(len(at), np.uint64)
        for j in range(words):  # a shorter text's shingle ends where the text ends
            there = at + j < start[1:][text]
            code = mix64(code + np.uint64(j + 1)) + np.where(there, h[np.minimum(at + j, max(len(h) - 1, 0))] if len(h) else 0, np.uint64(j))
        code = mix64(code)
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    first = np.ones(len(code), bool)
    first[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    code, text = code[first], text[first]
    return code, np.searchsorted(text, np.arange(len(size) + 1))


def signatures(code: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """POSITIONS min-hashes of 16 bits of each (non-empty) set."""
    rnd = np.random.default_rng(20_240_605)
    factor = rnd.integers(1, 2**63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    n = len(begin) - 1
    out = np.empty((n, POSITIONS), np.uint16)
    step = max(1, n * 30_000 // max(len(code), 1))  # sets whose hashes stay in the processor's cache
    for a in range(0, n, step):
        b = min(n, a + step)
        x = code[begin[a] : begin[b]]
        at = begin[a:b] - begin[a]
        with np.errstate(over="ignore"):
            for i in range(POSITIONS):
                y = x * factor[i]
                y ^= y >> np.uint64(32)
                out[a:b, i] = mix64(np.minimum.reduceat(y, at)) & np.uint64(0xFFFF)
    return out


def index_keys(sig: np.ndarray) -> np.ndarray:
    """One key for each chunk and each of its positions left out."""
    out = np.empty((len(sig), POSITIONS), np.uint64)
    for c in range(CHUNKS):
        part = sig[:, c * WIDTH : (c + 1) * WIDTH].astype(np.uint64)
        for skip in range(WIDTH):
            key = np.zeros(len(sig), np.uint64)
            for j in range(WIDTH):
                if j != skip:
                    key = (key << np.uint64(16)) | part[:, j]
            out[:, c * WIDTH + skip] = mix64(key ^ np.uint64((c * WIDTH + skip + 1) * 0x9E3779B97F4A7C15 % 2**64))
    return out


def sketches(sig: np.ndarray) -> np.ndarray:
    """The lowest bits of the first SKETCH positions, as three 32-bit words."""
    bits = (sig[:, :SKETCH] & 1).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.uint32)


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1) <= SKETCH_LIMIT


def ties(key: np.ndarray, node: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect the nodes of each key as far as chains of near sketches do: one pair per node at most."""
    order = np.lexsort((node, key))
    key, node, sketch = key[order], node[order], sketch[order]
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(head)
    size = np.diff(np.append(first, len(key)))
    hub = np.repeat(first, size)
    several = np.repeat(size > 1, size)
    ok = np.zeros(len(key), bool)
    ok[several] = near(sketch[several], sketch[hub[several]])
    a, b = [node[ok & ~head]], [node[hub[ok & ~head]]]
    good = np.add.reduceat(ok.astype(np.int64), first) if len(first) else first
    for i in np.flatnonzero((good < size) & (size > 1)):  # keys whose first node isn't near all others
        s = slice(first[i], first[i] + size[i])
        for x, y in chains(sketch[s]):
            a.append(node[s][x])
            b.append(node[s][np.full(len(x), y)])
    a, b = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.column_stack([a, b]), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pairs[:, 0], pairs[:, 1]


def chains(sketch: np.ndarray):
    """Breadth first: (newly reached, from which) until all are reached; each node is compared with those still left."""
    left = np.arange(len(sketch))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            here = queue.pop()
            hit = near(sketch[left], sketch[here])
            if hit.any():
                reached, left = left[hit], left[~hit]
                yield reached, here
                queue += reached.tolist()


def exact_classes(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The least index of each set's class, by links on the full sets. Breadth first, as in `chains`."""
    root = np.arange(len(sets))
    if len(sets) < 2:
        return root
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    edge = np.concatenate([[0], np.cumsum(size)])
    has = np.zeros(int(flat.max()) + 1, np.int32)
    left = np.arange(len(sets))
    flat_left, edge_left = flat, edge[:-1]
    while len(left):
        start = left[0]
        queue, keep = [start], np.ones(len(left), bool)
        keep[0] = False
        while True:
            if not keep.all():
                chosen = np.repeat(keep, size[left])
                left, flat_left = left[keep], flat_left[chosen]
                edge_left = np.cumsum(size[left]) - size[left]
            if not queue or not len(left):
                break
            here = queue.pop()
            own = flat[edge[here] : edge[here + 1]]
            has[own] = 1
            common = np.add.reduceat(has[flat_left], edge_left)
            has[own] = 0
            hit = 100 * common >= percent * (size[left] + size[here] - common)
            root[left[hit]] = start
            queue += left[hit].tolist()
            keep = ~hit
    return root


def signed_sets(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(i, k, n, s, sig): id, a key of id and text, size and hash of the set, and the signature (null for no words)."""
    base = docs.select(F.col(id_col).alias("i"), blank_null(text_col).alias("t")).withColumn("k", F.xxhash64("i", "t"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import xxhash

        for piece in pieces(batches, "t", PIECE):
            off, data = text_bytes(piece.column("t"))
            code, begin = shingle_sets(data.tobytes(), off, words)
            n = np.diff(begin)
            full = np.flatnonzero(n)
            sig = signatures(code, np.append(begin[:-1][full], begin[-1])) if len(full) else np.zeros((0, POSITIONS), np.uint16)
            s = [xxhash.xxh3_64_intdigest(code[a:b].tobytes()) for a, b in zip(begin[:-1], begin[1:], strict=True)]
            packed: list = [None] * len(n)
            for row, x in zip(full.tolist(), sig, strict=True):
                packed[row] = x.tobytes()
            yield pa.RecordBatch.from_arrays(
                [piece.column("i"), piece.column("k"), pa.array(n.astype(np.int64)), pa.array(np.array(s, np.uint64).view(np.int64)),
                 pa.array(packed, pa.binary())], names=["i", "k", "n", "s", "sig"])

    return base.select("i", "k", "t").mapInArrow(run, f"i {kind}, k long, n long, s long, sig binary")


def _packed(nodes: DataFrame, shards: int, hot: set[int]) -> DataFrame:
    """(shard, key, node, sketch): packed arrays of index entries per task batch and shard of the keys' hashes. An entry
    of a hot key goes to one of several shards, by node."""

    def run(batches):
        hot_keys = np.array(sorted(hot), np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, POSITIONS)
            node = np.asarray(batch.column("s")).astype(np.int64)
            key = index_keys(sig).ravel()
            who = np.repeat(np.arange(len(node)), POSITIONS)
            shard = ((key >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)
            if len(hot_keys):
                is_hot = np.isin(key, hot_keys)
                salt = mix64(node[who[is_hot]].view(np.uint64) ^ key[is_hot]) % np.uint64(shards)
                shard[is_hot] = salt.astype(np.int64)
            order = np.argsort(shard, kind="stable")
            edge = np.searchsorted(shard[order], np.arange(shards + 1))
            sk, low = sketches(sig), key.astype(np.uint32)
            for r in np.flatnonzero(np.diff(edge)):
                some = order[edge[r] : edge[r + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(r)], pa.int64()), pa.array([low[some].tobytes()], pa.binary()), pa.array([node[who[some]].tobytes()], pa.binary()),
                     pa.array([sk[who[some]].tobytes()], pa.binary())], names=["shard", "key", "node", "sketch"])

    return nodes.select("s", "sig").mapInArrow(run, "shard long, key binary, node binary, sketch binary")


def _tie(group: pa.Table) -> pa.Table:
    key = np.frombuffer(b"".join(group.column("key").to_pylist()), np.uint32)
    node = np.frombuffer(b"".join(group.column("node").to_pylist()), np.int64)
    sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint32).reshape(-1, SKETCH // 32)
    a, b = ties(key, node, sketch)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _hot(nodes: DataFrame, n_nodes: int) -> set[int]:
    """Index keys that hold more than HOT nodes, estimated from one node in 32; at most 2 * POSITIONS * nodes / HOT of
    them. Their entries are dealt to several shards by node; nodes of a hot key in different shards are tied by `_across`."""
    if n_nodes <= HOT:
        return set()

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, POSITIONS)
                yield pa.RecordBatch.from_arrays([pa.array(index_keys(sig).ravel().view(np.int64))], names=["key"])

    some = nodes.where(F.pmod(F.xxhash64("s"), F.lit(32)) == 0).select("sig").mapInArrow(run, "key long")
    found = some.groupBy("key").count().where(F.col("count") > HOT // 64).select("key").collect()
    return {r["key"] % 2**64 for r in found}


def _across(nodes: DataFrame, hot: set[int], shards: int, labels: DataFrame) -> DataFrame:
    """Ties between shards of hot keys. Entries whose class is not the key's largest go to all of the key's shards, the
    others to their own; every pair of different classes meets in one of them."""

    def entries(batches):
        hot_keys = np.array(sorted(hot), np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, POSITIONS)
            node, root = (np.asarray(batch.column(c)).astype(np.int64) for c in ("s", "root"))
            key = index_keys(sig)
            row, col = np.nonzero(np.isin(key, hot_keys))
            sk = sketches(sig)
            k = key[row, col]
            salt = (mix64(node[row].view(np.uint64) ^ k) % np.uint64(shards)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k.view(np.int64)), pa.array(salt), pa.array(node[row]), pa.array(root[row]), pa.array([sk[r].tobytes() for r in row], pa.binary())],
                names=["key", "salt", "node", "root", "sketch"])

    rows = (nodes.select("s", "sig").join(labels.select(F.col("node").alias("s"), "root"), "s", "left")
            .withColumn("root", F.coalesce("root", "s"))
            .mapInArrow(entries, "key long, salt long, node long, root long, sketch binary"))
    rows = written(rows, "neardup_hot")
    largest = (rows.groupBy("key", "root").count().groupBy("key").agg(F.max_by("root", F.struct("count", "root")).alias("main")))
    rows = rows.join(F.broadcast(largest), "key")  # at most as many rows as hot keys
    rest = rows.where("root != main")
    stay = rows.join(rest.select("key").distinct(), "key", "left_semi").select("key", "salt", "node", "sketch")
    spread = rest.select("key", F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("salt"), "node", "sketch")

    def tie(group: pa.Table) -> pa.Table:
        key = np.asarray(group.column("key")).astype(np.int64).view(np.uint64)
        node = np.asarray(group.column("node")).astype(np.int64)
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint32).reshape(-1, SKETCH // 32)
        a, b = ties(key, node, sketch)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return stay.unionByName(spread).distinct().groupBy("key", "salt").applyInArrow(tie, "a long, b long")


def _links(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): nodes of a task's group tied to the first of their class, by full sets. members: (task, part, s, bytes)."""

    def run(group: pa.Table) -> pa.Table:
        part = np.asarray(group.column("part")).astype(np.int64)
        node = np.asarray(group.column("s")).astype(np.int64)
        raw = group.column("set").to_pylist()
        a, b = [], []
        order = np.lexsort((node, part))
        fresh = np.ones(len(order), bool)  # documents that repeat id and text give their node's set again
        fresh[1:] = (node[order][1:] != node[order][:-1]) | (part[order][1:] != part[order][:-1])
        order = order[fresh]
        edge = np.flatnonzero(np.diff(part[order], prepend=part[order][0] - 1, append=part[order][-1] + 1))
        for x, y in zip(edge[:-1], edge[1:], strict=True):
            some = order[x:y]
            root = exact_classes([np.frombuffer(raw[i], np.uint64) for i in some], percent)
            tied = np.flatnonzero(root != np.arange(len(some)))
            a.append(node[some[tied]])
            b.append(node[some[root[tied]]])
        return pa.table({"a": pa.array(np.concatenate(a), pa.int64()), "b": pa.array(np.concatenate(b), pa.int64())})

    return members.groupBy("task").applyInArrow(run, "a long, b long")


def _cluster_sets(docs: DataFrame, id_col: str, text_col: str, words: int, nodes: DataFrame) -> DataFrame:
    """(s, root, size, set): the full sets of the candidate clusters' nodes, from one document of each."""
    base = docs.select(F.col(id_col).alias("i"), blank_null(text_col).alias("t")).withColumn("k", F.xxhash64("i", "t"))

    def run(batches):
        for piece in pieces(batches, "t", PIECE):
            off, data = text_bytes(piece.column("t"))
            code, begin = shingle_sets(data.tobytes(), off, words)
            sets = [code[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("s", "root", "size")), pa.array(sets, pa.binary())],
                                             names=["s", "root", "size", "set"])

    joined = base.select("k", "t").join(nodes, "k")
    return joined.select("s", "root", "size", "t").mapInArrow(run, "s long, root long, size long, set binary")


def shingle_counters(sets: DataFrame) -> np.ndarray:
    """How many nodes have a shingle, by the lowest bits of its hash: COUNTERS numbers, whatever the number of shingles."""
    part = 4096

    def count(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column("set").to_pylist()), np.uint64)
                total += np.bincount((x & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        at = [i for i in range(0, COUNTERS, part) if total[i : i + part].any()]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([total[i : i + part].tobytes() for i in at], pa.binary())], names=["at", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in group.column("counts").to_pylist())
        return pa.table({"at": group.column("at").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(COUNTERS, np.int64)
    kinds = "at int, counts binary"
    for r in sets.select("set").mapInArrow(count, kinds).groupBy("at").applyInArrow(add, kinds).collect():  # COUNTERS numbers in all
        out[r["at"] : r["at"] + part] = np.frombuffer(r["counts"], np.int64)
    return out


def prefix(x: np.ndarray, counters: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of a set of which one is shared with every set that is `percent` % alike."""
    order = np.lexsort((x, counters[(x & np.uint64(COUNTERS - 1)).astype(np.int64)]))
    return x[order[: len(x) - -(-percent * len(x) // 100) + 1]]


def _prefixes(label: DataFrame, percent: int) -> DataFrame:
    """(root, s, class, main, n, f): a row per prefix shingle of each node."""
    shared = label.sparkSession.sparkContext.broadcast(shingle_counters(label))

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                some = batch.slice(start, 2000)
                sets = [np.frombuffer(x, np.uint64) for x in some.column("set").to_pylist()]
                chosen = [prefix(x, shared.value, percent) for x in sets]
                size = np.fromiter(map(len, chosen), np.int64, len(chosen))
                row = np.repeat(np.arange(len(sets)), size)
                n = np.fromiter(map(len, sets), np.int64, len(sets))
                yield pa.RecordBatch.from_arrays([*(some.column(c).take(pa.array(row)) for c in ("root", "s", "class", "main")), pa.array(n[row]),
                                                  pa.array(np.concatenate(chosen).view(np.int64) if len(row) else row)], names=["root", "s", "class", "main", "n", "f"])

    return label.select("root", "s", "class", "main", "set").mapInArrow(run, "root long, s long, class long, main long, n long, f long")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of (a, b) those that are alike by their full sets."""

    def run(batches):
        for batch in batches:
            a, b = ([np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("x", "y"))
            same = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b, strict=True)], np.int64)
            size = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)], np.int64)
            ok = np.flatnonzero(100 * same >= percent * (size - same))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(ok)), batch.column("b").take(pa.array(ok))], names=["a", "b"])

    both = (pairs.join(sets.select(F.col("s").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("s").alias("b"), F.col("set").alias("y")), "b"))
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _links_between(label: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b): the links of large clusters between nodes of different classes. label: (root, s, class, main, set), a row per
    node, `main` being its cluster's largest class."""
    rows = written(_prefixes(label, percent), "neardup_prefixes")
    # shingles of one class only link nothing
    by_shingle = rows.groupBy("root", "f").agg(F.count(F.lit(1)).alias("nodes"), F.min("class").alias("x"), F.max("class").alias("y")).where("x != y")
    by_shingle = written(by_shingle.select("root", "f", "nodes"), "neardup_shingles")
    cool = rows.join(by_shingle.where(F.col("nodes") <= HOT_SHINGLE).select("root", "f"), ["root", "f"], "left_semi")
    a, b = (cool.select("root", "f", *[F.col(c).alias(f"{c}{i}") for c in ("s", "class", "n")]) for i in (1, 2))
    met = a.join(b, ["root", "f"]).where(f"(n1 < n2 OR (n1 = n2 AND s1 < s2)) AND 100 * n1 >= {percent} * n2 AND class1 != class2")
    shared = met.groupBy(F.col("s1").alias("a"), F.col("s2").alias("b"), "n1", "n2").agg(F.count(F.lit(1)).alias("c"))
    # beyond what the prefixes share, a pair can only share one side's other shingles
    enough = f"(100 + {percent}) * (c + ceil({percent} * greatest(n1, n2) / 100) - 1) >= {percent} * (n1 + n2)"
    found = _confirm(shared.where(enough).select("a", "b"), label, percent)
    hot = by_shingle.where(F.col("nodes") > HOT_SHINGLE).select("root", "f")
    if hot.isEmpty():
        return found
    # nodes that have a hot shingle in their prefix: pairs of blocks, of which one is outside the main class
    nodes = written(rows.join(hot, ["root", "f"], "left_semi").select("root", "s", (F.col("class") == F.col("main")).alias("inner")).distinct(), "neardup_hot_nodes")
    half = max(1, block // 2)
    sizes = nodes.groupBy("root").agg(*[F.expr(f"cast(ceil(count_if({x}) / {half}) AS BIGINT)").alias(n) for x, n in (("NOT inner", "outside"), ("inner", "inside"))])
    dealt = label.join(nodes, ["root", "s"]).join(sizes, "root")
    own = dealt.withColumn("own", F.expr("pmod(xxhash64(s), if(inner, inside, outside))"))
    # blocks 0 to outside - 1 are outside the main class, the others inside it
    outer = own.where("NOT inner").select("root", "s", "set", F.explode(F.expr("transform(sequence(0L, outside + inside - 1), j -> struct(least(own, j) AS i, greatest(own, j) AS j))")).alias("p"))
    inner = own.where("inner AND outside > 0").select("root", "s", "set", F.explode(F.expr("transform(sequence(0L, outside - 1), j -> struct(j AS i, outside + own AS j))")).alias("p"))
    placed = written(outer.unionByName(inner).select("s", "set", F.xxhash64("root", "p.i", "p.j").alias("part")), "neardup_block_pairs")
    tasks = max(1, math.ceil((placed.agg(F.sum(F.octet_length("set"))).first()[0] or 0) / (4 << 20)))
    return found.unionByName(_links(placed.withColumn("task", F.pmod("part", F.lit(tasks))), percent))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
            block: int = BLOCK) -> DataFrame:
    """One row per row of docs: id, `k` (a key of id and text), n_shingles, component_id (the least id of its class; its
    own without words)."""
    signed = written(signed_sets(docs, id_col, text_col, words), "neardup_sets")
    nodes = written(signed.where("n > 0").groupBy("s").agg(F.min("k").alias("k"), F.first("sig").alias("sig")), "neardup_nodes")
    n_nodes = nodes.count()
    shards = max(1, math.ceil(n_nodes * POSITIONS / SHARD_ROWS))
    hot = _hot(nodes, n_nodes)
    tied = _packed(nodes, shards, hot).groupBy("shard").applyInArrow(_tie, "a long, b long")
    clusters = components(tied, "neardup_ties")
    if hot:
        more = _across(nodes, hot, shards, clusters)
        clusters = components(more.unionByName(clusters.select(F.col("node").alias("a"), F.col("root").alias("b"))), "neardup_ties")
    # full sets of candidate clusters, in blocks
    sized = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    of_cluster = (nodes.select("s", "k").join(clusters, F.col("s") == F.col("node")).join(sized, "root")
                  .select("s", "k", "root", "size"))
    sets = written(_cluster_sets(docs, id_col, text_col, words, of_cluster), "neardup_cluster_sets")
    total = sets.agg(F.coalesce(F.sum(F.octet_length("set")), F.lit(0)).alias("b"), F.coalesce(F.max("size"), F.lit(0)).alias("m")).first()
    tasks = max(1, math.ceil(total["b"] / (4 << 20)))
    blocks = F.expr(f"cast(ceil(size / {block}) AS BIGINT)")
    dealt = sets.withColumn("blocks", blocks).withColumn("own", F.expr("pmod(xxhash64(s), blocks)"))
    # nodes of large clusters that all of the cluster's blocks see
    everywhere = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("s", F.lit(1)), F.greatest(F.col("size") / SHARED, F.lit(1)).cast("long")) == 0)

    def links(rows: DataFrame) -> DataFrame:
        placed = rows.withColumn("part", F.xxhash64("root", "block")).withColumn("task", F.pmod(F.col("part"), F.lit(tasks)))
        return _links(placed.select("task", "part", "s", "set"), percent)

    seen = F.when(everywhere, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("own"))
    found = links(dealt.select("root", "s", "set", F.explode(seen).alias("block")))
    large = total["m"] > block
    final = components(found, "neardup_links")
    if large:
        label = dealt.where("blocks > 1").select("root", "s", "set").dropDuplicates(["s"])
        label = label.join(final.select(F.col("node").alias("s"), F.col("root").alias("class")), "s", "left").withColumn("class", F.coalesce("class", "s"))
        main = label.groupBy("root", "class").count().groupBy("root").agg(F.max_by("class", F.struct("count", "class")).alias("main"))
        again = _links_between(written(label.join(main, "root"), "neardup_large"), percent, block)
        final = components(again.unionByName(final.select(F.col("node").alias("a"), F.col("root").alias("b"))), "neardup_links")
    named = signed.select("i", "k", "n", "s").join(final.select(F.col("node").alias("s"), "root"), "s", "left")
    named = named.withColumn("class", F.when(F.col("n") > 0, F.coalesce("root", "s")))
    least = named.where("n > 0").groupBy("class").agg(F.min("i").alias("least"))
    return (named.join(least, "class", "left")
            .select(F.col("i").alias(id_col), "k", F.col("n").alias("n_shingles"), F.coalesce("least", "i").alias("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, with all their columns, whose id is their class's least; rows that repeat id and text stay
    once. Rows without an id stay where no row of their class has one; rows without words all stay."""
    found = classes(docs, id_col, text_col, **options)
    kept = found.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col("k").alias("kept_k")).distinct()
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(F.col(id_col), blank_null(text_col)).alias("k"))
    joined = keyed.join(kept, F.col("k") == F.col("kept_k"), "left_semi")
    return joined.dropDuplicates(["k"]).select("row.*")
