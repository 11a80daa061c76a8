"""Operator 10: removal of repeated byte strings with suffix arrays.

Every byte that is covered by a string of `length` bytes (400) which also starts anywhere else goes; matches never cross
texts. Suffix arrays of a whole corpus don't fit into tasks, so the corpus is first cut where equal strings must meet:

1. Anchors. Of the GRAM-byte grams inside a string, the one with the least hash (the first of equal ones) is its
   anchor: equal strings have equal anchors at the same place. Strings that follow one another share anchors, so a text
   falls into contexts: an anchor and the bytes of all strings anchored there (at most 2 * length - GRAM).
2. Contexts that occur more than once are repeated as a whole. If all contexts of an anchor are equal, or it has one
   context only, that is all there is to know. Counting is pre-aggregated, so a hot context costs a row per task.
3. The distinct contexts of the remaining anchors are shared out to shards of some MB by anchor. Those that agree with none
   of their anchor's others around the anchor, however a string may lie about it, are done. Of the others, a shard's suffix array
   is built by Larsson and Sadakane's refinement (groups of suffixes that agree in h bytes are sorted by the rank h
   bytes further on; sorted groups are left alone), its common prefixes by Kasai's method, run side by side for all
   contexts. Strings with a common prefix of `length` with a neighbour are repeated.
4. An anchor with more than CHUNK contexts is dealt to several shards. These send sorted digests of their strings by
   digest range to be merged, where a binary search counts each shard's strings among those of all.

A unit says what a string is made of: bytes (`Bytes`, strings of 400), or words (`Words`, runs of 51 words split at white
space, each by a 64-bit hash of its bytes). Both can be asked for at once: texts are then read, cut and shuffled once for both, and
an anchor's lowest bit says which unit it belongs to. A run of 51 words has often fewer than 400 bytes.

Nothing is capped or sampled and no pair of texts is ever listed; a group's cost grows with its contexts. Null and empty
texts have no bytes, and texts shorter than `length` lose none. Rows that repeat id and text count as further
occurrences. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import blank_null, mix64, pieces, text_bytes, written

LENGTH, GRAM = 400, 64
WORDS, WORD_GRAM = 51, 8
PLACE = 24  # bits of a place inside a stretch; the others order grams by hash
CHUNK = 4000
SHARD_BYTES = 2 << 20
#: Bytes of text that a task works on at once; a longer text is gone through in overlapping stretches of that size.
PIECE = 256 << 10


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the `gram` (a power of two) symbols from each place, by doubling (places too near the end have none)."""
    h, n = data.astype(np.uint64) + np.uint64(1), 1
    base = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        while n < gram:
            more = h[n:].copy()
            h = h[:-n]
            h *= base
            h += more
            base = base * base
            n *= 2
    return mix64(h)


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of the string from each place, and all grams' hashes. len(data) < 2 ** PLACE."""
    grams = gram_hashes(data, gram)
    low = np.uint64((1 << PLACE) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)  # least hash first, then the first place
    n, window = 1, length - gram + 1
    while n * 2 <= window:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    if n < window:
        least = np.minimum(least[: len(least) - (window - n)], least[window - n :])
    return (least & low).astype(np.int64), grams


def stretch_contexts(data: np.ndarray, raw: bytes, begin: np.ndarray, length: int, gram: int):
    """For texts whose symbols are data[begin[i] : begin[i + 1]] (raw: the same as bytes): text number, first string, number
    of strings, the anchor's hash, and a digest of the context, one entry per context."""
    import xxhash

    none = np.zeros(0, np.int64)
    if len(data) < length:
        return [none, none, none, none.astype(np.uint64), none.astype(np.uint64)]
    anchor, grams = anchors(data, length, gram)
    start = np.arange(len(anchor))
    text = np.searchsorted(begin, start, side="right") - 1
    inside = start + length <= begin[text + 1]
    start, text, anchor = start[inside], text[inside], anchor[inside]
    if not len(start):
        return [none, none, none, none.astype(np.uint64), none.astype(np.uint64)]
    head = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    count = np.diff(np.append(head, len(start)))
    lo, a = start[head], anchor[head]
    size = data.itemsize
    digest = xxhash.xxh3_64_intdigest
    ctx = [digest(raw[s : e], seed=r) for s, e, r in zip((lo * size).tolist(), ((lo + count + length - 1) * size).tolist(), (a - lo).tolist(), strict=True)]
    return [text[head], lo - begin[text[head]], count, grams[a], np.array(ctx, np.uint64)]


class Unit:
    """What strings are made of: `length` symbols, with anchors of `gram` symbols; a symbol takes `size` bytes."""

    def __init__(self, length: int):
        self.length = length

    def encoded(self, raw: bytes, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of texts raw[begin[i] : begin[i + 1]], and where each text's begin."""
        raise NotImplementedError

    def contexts(self, raw: bytes, begin: np.ndarray) -> list[np.ndarray]:
        """See `stretch_contexts`; symbols are gone through in overlapping stretches."""
        data, begin = self.encoded(raw, begin)
        own = data.tobytes() if self.size > 1 else raw
        step = max(PIECE // self.size, self.length)
        parts = []
        for at in range(0, max(1, len(data) - self.length + 1), step):
            end = min(len(data), at + step + self.length - 1)
            first = max(0, int(np.searchsorted(begin, at, side="right")) - 1)
            last = int(np.searchsorted(begin, end, side="left"))
            inner = np.clip(begin[first : last + 1], at, end) - at
            text, lo, n, fp, ctx = stretch_contexts(data[at:end], own[at * self.size : end * self.size], inner, self.length, self.gram)
            parts.append([text + first, lo + np.maximum(0, at - begin[text + first]), n, fp, ctx])
        return [np.concatenate(x) for x in zip(*parts, strict=True)]

    def cut(self, text: bytes, cuts: list) -> list[bytes]:
        """The symbols of the contexts (first string, number of strings) of a text."""
        data = self.encoded(text, np.array([0, len(text)]))[0].tobytes()
        return [data[self.size * a : self.size * (a + n + self.length - 1)] for a, n in cuts]

    def symbols(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """All texts' symbols as small numbers, each text's followed by one more place; their sizes; a number above all."""
        raise NotImplementedError


class Bytes(Unit):
    """Strings of bytes."""

    mark, gram, size, kind = 0, GRAM, 1, np.uint8

    def __init__(self, length: int = LENGTH):
        super().__init__(length)

    def encoded(self, raw: bytes, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(raw, np.uint8), begin

    def symbols(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        return np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.int32), np.fromiter(map(len, texts), np.int64, len(texts)), 256


class Words(Unit):
    """Runs of words, each word as a 64-bit hash of its bytes."""

    mark, gram, size, kind = 1, WORD_GRAM, 8, np.uint64

    def __init__(self, length: int = WORDS):
        super().__init__(length)

    def encoded(self, raw: bytes, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found, starts, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        while at < len(raw):  # pieces that end between words
            end = min(len(raw), at + PIECE)
            if end < len(raw):
                blank = BLANK.search(raw, end)
                end = min(blank.start() if blank else len(raw), int(begin[np.searchsorted(begin, end)]))
            h, start = word_hashes(np.frombuffer(raw, np.uint8, end - at, at), begin[(begin >= at) & (begin < end)] - at)
            found.append(h)
            starts.append(start + at)
            at = end
        return np.concatenate(found), np.searchsorted(np.concatenate(starts), begin)

    def symbols(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        size = np.fromiter(map(len, texts), np.int64, len(texts)) // 8
        words, number = np.unique(np.frombuffer(b"".join(texts), np.uint64), return_inverse=True)
        sym = np.zeros(len(number) + len(texts), np.int32)
        own = np.ones(len(sym), bool)
        own[np.cumsum(size + 1) - 1] = False
        sym[own] = number
        return sym, size, len(words)


BLANK = re.compile(rb"[\x20\x09-\x0D]")
IS_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64))
ODD = 0x9E3779B97F4A7C15
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ODD ** i and its inverse modulo 2 ** 64, for i below n."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        with np.errstate(over="ignore"):
            rows = [np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(x))])) for x in (ODD, pow(ODD, -1, 1 << 64))]
        _POWERS[:] = [tuple(rows)]
    return _POWERS[0]


def word_hashes(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of data, and where it starts; words also end where a text begins."""
    solid = ~IS_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[begin] = True
    start, stop = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:-1]
    stop[:-1] &= ~solid[1:] | edge[1:-1]
    a, b = np.flatnonzero(start), np.flatnonzero(stop) + 1
    up, down = powers(len(data))
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.add.accumulate(BYTE_VALUES[data] * up[: len(data)])])
        return mix64((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64) * BYTE_VALUES[0]), a


def suffix_array(sym: np.ndarray, ends: np.ndarray, top: int = 256) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """The order of all suffixes of sym (symbols below `top`; a separator, `top`, at `ends`, and no two alike), and the
    ranks of all substrings of w and 8 w symbols, w being as many as fit into 63 bits (7 bytes). Larsson and Sadakane: only
    groups not yet told apart are sorted on."""
    n = len(sym)
    bits = max(1, int(top).bit_length())
    width = 63 // bits
    key = np.zeros(n, np.int64)
    apart = np.zeros(n, bool)  # a separator within the first symbols makes a suffix unlike all others
    padded = np.concatenate([sym, np.full(width, top)]).astype(np.int64)
    sep = np.zeros(n + width, bool)
    sep[ends] = True
    sep[n:] = True
    for j in range(width):
        key = (key << bits) | np.where(apart, 0, padded[j : j + n])
        apart |= sep[j : j + n]
    order = np.argsort(key)
    ended = np.flatnonzero(apart[order])  # separators rank by place; their keys are shared with no other suffix
    order[ended] = order[ended][np.lexsort((order[ended], key[order[ended]]))]
    sorted_key = key[order]
    fresh = np.ones(n, bool)
    fresh[1:] = (sorted_key[1:] != sorted_key[:-1]) | apart[order][1:] | apart[order][:-1]
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[n] = -1
    place_bits = int(n + 2).bit_length()
    h, kept = width, {width: rank[:n].copy()}
    while True:
        alone = fresh.copy()
        alone[:-1] &= fresh[1:]
        todo = np.flatnonzero(~alone)  # places of the order in groups of more than one
        if not len(todo):
            break
        who = order[todo]
        both = rank[who] * (n + 2) + rank[np.minimum(who + h, n)] + 1
        if 3 * place_bits <= 63:  # the keys with their places fit into one number, which sorts faster
            packed = np.sort((both << place_bits) | np.arange(len(both)))
            sub, both = packed & ((1 << place_bits) - 1), packed >> place_bits
        else:
            sub = np.argsort(both)
            both = both[sub]
        who = who[sub]
        order[todo] = who
        split = np.ones(len(who), bool)
        split[1:] = both[1:] != both[:-1]
        fresh[todo] = split
        rank[who] = np.maximum.accumulate(np.where(split, todo, 0))
        h *= 2
        if h == 8 * width:
            kept[h] = rank[:n].copy()
    kept.setdefault(8 * width, rank[:n].copy())
    return order, kept


def common_prefixes(sym: np.ndarray, begin: np.ndarray, order: np.ndarray, ranks: dict[int, np.ndarray]) -> np.ndarray:
    """By place: symbols in common with the suffix before it in the order. Kasai's method: from one place to the next the
    common prefix shrinks by one at most. Contexts (from begin[i] to begin[i + 1]) are gone through side by side."""
    n = len(sym)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int32)
    size = np.diff(np.append(begin, n))
    lanes = np.argsort(-size, kind="stable")
    starts, size = begin[lanes], size[lanes]
    active = len(size) - np.searchsorted(size[::-1], np.arange(int(size[0]) if len(size) else 0), side="right")
    have = np.zeros(len(starts), np.int64)
    levels = (*sorted(ranks.items(), reverse=True), (1, sym))
    for t, live in enumerate(active.tolist()):
        p = starts[:live] + t
        j = before[p]
        h = np.where(j >= 0, np.maximum(have[:live] - 1, 0), 0)
        todo = np.flatnonzero(j >= 0)
        a, b = p[todo] + h[todo], j[todo] + h[todo]
        ok = (a < n) & (b < n)
        ok[ok] = sym[a[ok]] == sym[b[ok]]
        todo = todo[ok]  # mostly the prefix has just lost its first symbol, and nothing is added
        for width, same in levels:
            more = todo
            while len(more):
                a, b = p[more] + h[more], j[more] + h[more]
                ok = (a < n) & (b < n)
                ok[ok] = same[a[ok]] == same[b[ok]]
                more = more[ok]
                h[more] += width
        have[:live] = h
        out[p] = h
    return out


def repeated(texts: list[bytes], unit: Unit | None = None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of each text: whether the unit's string from each place starts anywhere else in the texts, and the number of a string
    equal to it (equal strings share the number)."""
    unit = unit or Bytes()
    sym, size, top = unit.symbols(texts)
    begin = np.cumsum(size + 1) - size - 1
    ends = begin + size
    plain = sym.copy()
    plain[ends] = top
    sym[ends] = top + np.arange(len(texts))
    order, ranks = suffix_array(plain, ends, top)
    prefix = common_prefixes(sym, begin, order, ranks)[order]
    linked = prefix >= unit.length
    either = linked.copy()
    either[:-1] |= linked[1:]
    flag, same = np.zeros(len(sym), bool), np.empty(len(sym), np.int64)
    flag[order] = either
    same[order] = np.cumsum(~linked)
    strings = np.maximum(size - unit.length + 1, 0)
    return ([flag[b : b + s] for b, s in zip(begin, strings, strict=True)],
            [same[b : b + s] for b, s in zip(begin, strings, strict=True)])


def may_repeat(texts: list[bytes], fp: np.ndarray, unit: Unit) -> np.ndarray:
    """Which contexts may hold a string that another one with the same anchor has. Such a string has some symbols before the
    anchor's gram and the others behind it; so two contexts agree around it as far as one of a few splits says."""
    import xxhash

    size = np.fromiter(map(len, texts), np.int64, len(texts)) // unit.size
    begin = np.cumsum(size) - size
    grams = gram_hashes(np.frombuffer(b"".join(texts), unit.kind), unit.gram) if size.sum() >= unit.gram else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(texts)), size)[: len(grams)]
    hit = np.flatnonzero((grams & ~np.uint64(1)) == (fp.view(np.uint64)[owner] & ~np.uint64(1)))
    first = np.unique(owner[hit], return_index=True)  # the anchor is the first place of its hash in its context
    place = np.full(len(texts), -1, np.int64)
    place[first[0]] = hit[first[1]] - begin[first[0]]
    others = unit.length - unit.gram
    step = max(1, others // 6)
    digest, out = xxhash.xxh3_64_intdigest, place < 0
    for before in range(0, others + 1, step):
        behind = max(0, others - before - step + 1)
        some = np.flatnonzero((place >= before) & (place + unit.gram + behind <= size))
        seen = np.array([digest(texts[i][(p - before) * unit.size : (p + unit.gram + behind) * unit.size])
                         for i, p in zip(some.tolist(), place[some].tolist(), strict=True)], np.uint64)
        _, which, times = np.unique(np.column_stack([seen, fp[some].view(np.uint64)]), axis=0, return_inverse=True, return_counts=True)
        out[some[times[which.ravel()] > 1]] = True
    return out


def flag_runs(flag: np.ndarray) -> list[dict]:
    """The runs of true entries."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.astype(np.int8), [0]])))
    return [{"at": int(a), "n": int(b - a)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


RUNS = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    df = docs.select(F.col(id_col).alias("i"), blank_null(text_col).alias("t"))
    return df.withColumn("k", F.xxhash64("i", "t"))


def _anchored(keyed: DataFrame, units: list) -> DataFrame:
    """One row per context of every text and unit; the lowest bit of `fp` is the unit's mark."""
    names = ("k", "lo", "n", "fp", "ctx")

    def run(batches):
        for piece in pieces(batches, "t", PIECE):
            off, data = text_bytes(piece.column("t"))
            raw, keys = data.tobytes(), np.asarray(piece.column("k"))
            for unit in units:
                text, lo, count, fp, ctx = unit.contexts(raw, off)
                fp = (fp & ~np.uint64(1)) | np.uint64(unit.mark)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[text.astype(np.int64)], pa.int64()), pa.array(lo.astype(np.int32)), pa.array(count.astype(np.int32)),
                     pa.array(fp.view(np.int64)), pa.array(ctx.view(np.int64))], names=list(names))

    least = min(2 * u.length - 1 if isinstance(u, Words) else u.length for u in units)
    long_enough = keyed.where(F.octet_length("t") >= least).select("k", "t")
    return long_enough.mapInArrow(run, "k long, lo int, n int, fp long, ctx long")  # a text has less than 2 GB


def _with_bytes(keyed: DataFrame, members: DataFrame, units: list) -> DataFrame:
    """The members' bytes, cut out of their texts."""
    per_text = members.groupBy("k").agg(F.collect_list(F.struct("lo", "n", "fp", "ctx", "hot", "shard")).alias("cuts"))
    texts = keyed.select("k", "t").join(per_text, "k").select("k", "t", "cuts")

    def run(batches):
        for batch in pieces(batches, "t", PIECE):
            off, data = text_bytes(batch.column("t"))
            raw, cuts = data.tobytes(), batch.column("cuts")
            edge = np.asarray(cuts.offsets).astype(np.int64)
            flat = pa.RecordBatch.from_struct_array(cuts.flatten())
            text = np.repeat(np.arange(batch.num_rows), np.diff(edge))
            fp, lo, n = (np.asarray(flat.column(c)).astype(np.int64) for c in ("fp", "lo", "n"))
            for unit in units:
                own = np.flatnonzero(fp & 1 == unit.mark)
                if not len(own):
                    continue
                first = np.flatnonzero(np.diff(text[own], prepend=-1))
                out = []
                for x, y in zip(first.tolist(), [*first[1:].tolist(), len(own)], strict=True):
                    some, i = own[x:y], int(text[own[x]])
                    out += unit.cut(raw[off[i] : off[i + 1]], list(zip(lo[some].tolist(), n[some].tolist(), strict=True)))
                rest = flat.take(pa.array(own))
                yield pa.RecordBatch.from_arrays([*(rest.column(c) for c in ("shard", "fp", "ctx", "hot")), pa.array(out, pa.binary())],
                                                 names=["shard", "fp", "ctx", "hot", "raw"])

    return texts.mapInArrow(run, "shard long, fp long, ctx long, hot boolean, raw binary")


def repeated_strings(keyed: DataFrame, units: list) -> DataFrame:
    """(k, runs): by text key, the runs of places from which a unit's string is repeated, with the unit's mark."""
    unit_of = {u.mark: u for u in units}
    rows = written(_anchored(keyed, units), "suffix_contexts")
    kinds = rows.groupBy("fp", "ctx").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("k", "lo", "n")).alias("one"))
    kinds = written(kinds, "suffix_kinds")
    several = kinds.groupBy("fp").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > 1)
    mark = F.expr("cast(fp & 1 AS INT)").alias("u")
    # whole contexts that occur more than once
    whole = (rows.join(kinds.where(F.col("times") > 1).select("fp", "ctx"), ["fp", "ctx"], "left_semi")
             .select("k", mark, F.col("lo").cast("long").alias("at"), F.col("n").cast("long").alias("n")))
    # parts of contexts whose anchor has others
    members = (kinds.join(several, "fp").select("fp", "ctx", "times", "one.k", "one.lo", "one.n", "kinds")
               .withColumn("hot", F.col("kinds") > CHUNK)
               .withColumn("chunk", F.expr(f"pmod(ctx, cast(ceil(kinds / {CHUNK}) AS BIGINT))")))
    members = written(members, "suffix_members")
    size = F.expr("CASE " + " ".join(f"WHEN fp & 1 = {u.mark} THEN (n + {u.length}) * {u.size}" for u in units) + " END")
    total = members.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b"),
                        F.max("hot").alias("hot"), F.sum(F.when(F.col("hot"), F.col("n"))).alias("hot_strings")).first()
    shards = max(1, math.ceil(total["b"] / SHARD_BYTES))
    ranges = max(1, math.ceil((total["hot_strings"] or 0) / 400_000))
    members = members.withColumn("shard", F.expr(f"pmod(xxhash64(fp, chunk), {shards}L)"))
    schema = ("fp long, ctx long, runs array<struct<at:long,n:long>>, part int, digest binary, whose binary, place binary")

    def sort_unit(group: pa.Table, unit) -> pa.Table:
        import xxhash

        raw = group.column("raw").to_pylist()
        fp, ctx, hot = (group.column(c).to_pylist() for c in ("fp", "ctx", "hot"))
        chosen = np.flatnonzero(may_repeat(raw, np.array(fp, np.int64), unit) | np.array(hot, bool)).tolist()  # a hot anchor's others may be elsewhere
        raw, fp, ctx, hot = ([x[i] for i in chosen] for x in (raw, fp, ctx, hot))
        flags, same = repeated(raw, unit) if raw else ([], [])
        runs = [flag_runs(f) for f in flags]
        keep = [i for i, r in enumerate(runs) if r]
        out = {"fp": [fp[i] for i in keep], "ctx": [ctx[i] for i in keep], "runs": [runs[i] for i in keep]}
        blank = [None] * len(keep)
        extra = {"part": blank[:], "digest": blank[:], "whose": blank[:], "place": blank[:]}
        mine = [i for i in range(len(raw)) if hot[i]]
        if mine:  # strings that other shards may have: one digest for each that isn't repeated here, one for the others
            whose = np.concatenate([np.full(len(same[i]), i, np.int64) for i in mine])
            place = np.concatenate([np.arange(len(same[i]), dtype=np.int32) for i in mine])
            _, first, which = np.unique(np.concatenate([same[i] for i in mine]), return_index=True, return_inverse=True)
            span, step = unit.length * unit.size, unit.size
            value = np.array([xxhash.xxh3_64_intdigest(raw[i][p * step : p * step + span], unit.mark)
                              for i, p in zip(whose[first].tolist(), place[first].tolist(), strict=True)], np.uint64)
            part = (value % np.uint64(ranges)).astype(np.int64)
            order = np.lexsort((value, part))
            label = np.empty(len(order), np.int64)
            label[order] = np.arange(len(order))
            all_label = label[which]  # by string: its digest's place in the order
            by = np.argsort(all_label, kind="stable")
            pairs = np.column_stack([np.array(fp, np.int64)[whose], np.array(ctx, np.int64)[whose]])
            edges = np.searchsorted(part[order], np.arange(ranges + 1))
            for r in range(ranges):
                a, b = int(edges[r]), int(edges[r + 1])
                if a == b:
                    continue
                x, y = np.searchsorted(all_label[by], [a, b])
                out["fp"].append(None), out["ctx"].append(None), out["runs"].append(None)
                extra["part"].append(r)
                extra["digest"].append(value[order][a:b].tobytes())
                extra["whose"].append(np.column_stack([all_label[by][x:y] - a, pairs[by][x:y]]).astype(np.int64).tobytes())
                extra["place"].append(place[by][x:y].astype(np.int32).tobytes())
        kinds_ = {"fp": pa.int64(), "ctx": pa.int64(), "runs": RUNS, "part": pa.int32(), "digest": pa.binary(), "whose": pa.binary(), "place": pa.binary()}
        return pa.table({c: pa.array((out | extra)[c], k) for c, k in kinds_.items()})

    def sort_shard(group: pa.Table) -> pa.Table:
        fp, ctx = (np.asarray(group.column(c)).astype(np.int64) for c in ("fp", "ctx"))
        once = np.unique(np.column_stack([fp, ctx]), axis=0, return_index=True)[1]  # texts that repeat a key give a context again
        tables = []
        for value, unit in unit_of.items():
            own = once[fp[once] & 1 == value]
            if len(own):
                tables.append(sort_unit(group.take(own), unit))
        return pa.concat_tables(tables)

    def merge(group: pa.Table) -> pa.Table:
        """Of the strings of several shards in a range of digests, those that more than one shard has."""
        own = [np.frombuffer(x, np.uint64) for x in group.column("digest").to_pylist()]
        every = np.sort(np.concatenate(own))
        fp, ctx, at = [], [], []
        for digest, whose, place in zip(own, *(group.column(c).to_pylist() for c in ("whose", "place")), strict=True):
            others = np.searchsorted(every, digest, side="right") - np.searchsorted(every, digest, side="left") > 1
            w = np.frombuffer(whose, np.int64).reshape(-1, 3)
            hit = others[w[:, 0]]
            fp.append(w[hit, 1])
            ctx.append(w[hit, 2])
            at.append(np.frombuffer(place, np.int32)[hit])
        fp, ctx, at = np.concatenate(fp), np.concatenate(ctx), np.concatenate(at).astype(np.int64)
        order = np.lexsort((at, ctx, fp))
        fp, ctx, at = fp[order], ctx[order], at[order]
        head = np.ones(len(at), bool)
        head[1:] = (fp[1:] != fp[:-1]) | (ctx[1:] != ctx[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(head)
        runs = [[{"at": int(a), "n": int(n)}] for a, n in zip(at[first], np.diff(np.append(first, len(at))), strict=True)]
        return pa.table({"fp": pa.array(fp[first]), "ctx": pa.array(ctx[first]), "runs": pa.array(runs, RUNS)})

    # shards cost time rather than bytes, so how many go to a task isn't left to Spark
    dealt = _with_bytes(keyed, members, units).repartition(shards, "shard")
    found = dealt.groupBy("shard").applyInArrow(sort_shard, schema)
    if total["hot"]:
        found = written(found, "suffix_found")
        across = (found.where("part IS NOT NULL").select("part", "digest", "whose", "place").groupBy("part")
                  .applyInArrow(merge, "fp long, ctx long, runs array<struct<at:long,n:long>>"))
        found = found.where("part IS NULL").select("fp", "ctx", "runs").unionByName(across)
    partly = (found.select("fp", "ctx", F.explode("runs").alias("r"))
              .join(members.where(F.col("times") == 1).select("fp", "ctx", "k", "lo"), ["fp", "ctx"])
              .select("k", mark, (F.col("lo").cast("long") + F.col("r.at")).alias("at"), F.col("r.n").alias("n")))
    return whole.unionByName(partly).groupBy("k").agg(F.collect_list(F.struct("u", "at", "n")).alias("runs"))


def covered(runs: pa.ListArray, unit: Unit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The maximal spans of bytes or words that the unit's strings from the runs' places cover: where each row's begin, and
    all rows' starts and stops."""
    edge = np.asarray(runs.offsets).astype(np.int64)
    flat = runs.flatten()
    u, at, n = (np.asarray(flat.field(i)).astype(np.int64) for i in range(3))
    row = np.repeat(np.arange(len(runs)), np.diff(edge))
    own = np.flatnonzero(u == unit.mark)
    own = own[np.lexsort((at[own], row[own]))]
    row, start = row[own], at[own]
    far = np.maximum.accumulate((row << 32) + start + n[own] - 1 + unit.length) - (row << 32)  # a text has less than 2 GB
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (start[1:] > far[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(row))[: len(first)] - 1
    return np.searchsorted(row[first], np.arange(len(runs) + 1)), start[first], far[last]


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    return b"".join(raw[x:y] for x, y in zip([0, *(y for _, y in spans)], [*(x for x, _ in spans), len(raw)], strict=True))


def word_bytes(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as spans of bytes, from the first word's beginning to the last word's end."""
    out, number, want = [], 0, iter(spans)
    span = next(want, None)
    start = 0
    for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw) if spans else ():
        if span is None:
            break
        if number == span[0]:
            start = m.start()
        number += 1
        if number == span[1]:
            out.append((start, m.end()))
            span = next(want, None)
    return out


def _with_runs(docs: DataFrame, keep: list[str], id_col: str, text_col: str, units: list) -> DataFrame:
    """(k0, k1, ..., t, runs)."""
    runs = repeated_strings(_keyed(docs, id_col, text_col), units)
    base = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], blank_null(text_col).alias("t"),
                       F.col(id_col).alias("i")).withColumn("k", F.xxhash64("i", "t")).drop("i")
    return base.join(runs, "k", "left").drop("k")


def dedup(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
          passages: int | None = None, texts: bool = True) -> DataFrame:
    """The columns `keep` of docs, and n_bytes, spans (removed bytes: array of struct of start and stop), kept_sha256;
    with `passages`, n_passage_words: words in runs of that many words that start anywhere else too; and with `texts`,
    kept: the remaining bytes."""
    unit, words = Bytes(length), Words(passages) if passages else None
    joined_ = _with_runs(docs, keep, id_col, text_col, [unit, *[words] * bool(words)])
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*kinds, "n_bytes long, spans array<struct<start:long,stop:long>>, kept_sha256 string", *["n_passage_words long"] * bool(words),
                        *["kept binary"] * texts])
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    def run(batches):
        for batch in pieces(batches, "t", PIECE):
            off, data = text_bytes(batch.column("t"))
            at, start, stop = covered(batch.column("runs"), unit)
            raw = data.tobytes()
            left = []
            for a, b, x, y in zip(off[:-1].tolist(), off[1:].tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                text = raw[a:b]
                left.append(without(text, list(zip(start[x:y].tolist(), stop[x:y].tolist(), strict=True))) if y > x else text)
            spans = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.StructArray.from_arrays([pa.array(start), pa.array(stop)], fields=list(span)))
            cols = [pa.array(np.diff(off)), spans, pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string())]
            if words:
                at, start, stop = covered(batch.column("runs"), words)
                total = np.concatenate([[0], np.cumsum(stop - start)])
                cols.append(pa.array(total[at[1:]] - total[at[:-1]]))
            cols += [pa.array(left, pa.binary())] * texts
            yield pa.RecordBatch.from_arrays([*(batch.column(f"k{i}") for i in range(len(keep))), *cols],
                                             names=[*keep, "n_bytes", "spans", "kept_sha256", *["n_passage_words"] * bool(words), *["kept"] * texts])

    return joined_.mapInArrow(run, schema)


def without_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_chars: str | None = None, words: int = WORDS) -> DataFrame:
    """docs with every run of `words` words that starts anywhere else too taken out of the text, from its first word's
    beginning to its last word's end. `n_chars` names a column that counts the text's characters. Null texts become empty."""
    unit = Words(words)
    columns = docs.columns
    rest = [c for c in columns if c not in (text_col, n_chars)]
    joined_ = _with_runs(docs, rest, id_col, text_col, [unit])
    kinds = {c: "string" if c == text_col else "long" if c == n_chars else docs.schema[c].dataType.simpleString() for c in columns}

    def run(batches):
        for batch in pieces(batches, "t", PIECE):
            off, data = text_bytes(batch.column("t"))
            at, start, stop = covered(batch.column("runs"), unit)
            raw = data.tobytes()
            left = []
            for a, b, x, y in zip(off[:-1].tolist(), off[1:].tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                text = raw[a:b]
                gone = word_bytes(text, list(zip(start[x:y].tolist(), stop[x:y].tolist(), strict=True)))
                left.append((without(text, gone) if gone else text).decode("utf-8", "replace"))
            made = {text_col: pa.array(left, pa.string()), n_chars: pa.array([len(t) for t in left], pa.int64())}
            made |= {c: batch.column(f"k{i}") for i, c in enumerate(rest)}
            yield pa.RecordBatch.from_arrays([made[c] for c in columns], names=columns)

    return joined_.mapInArrow(run, ", ".join(f"`{c}` {k}" for c, k in kinds.items()))
