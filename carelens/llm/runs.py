"""Operator 11: periodic runs of words, by Baier's grouping and Lyndon roots.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and length >= max(LEAST, 2 q)
that no neighbouring word extends keeping the period. Words are split at white space and compared as they are.

1. Stretches. Every word of a run is covered by a string of LEAST // 2 (6) words that occurs elsewhere in the text too: a
   run's words from place x on equal those from x + q or x - q on, for 6 words at least. So maximal stretches covered by
   repeated 6-word strings hold all runs whole, and only they go on. Hashes find them; a collision adds words, never loses any.
2. Lyndon arrays. The first phase of Baier's suffix sorter, run on a stretch under the order of its words and under the
   reverse order, gives at each place the longest Lyndon word that begins there, as the context of the place's final group:
   groups are taken from the greatest down; the nearest place to the left that is in a lower group has its context extended
   by the group's, and moves to a new group right above its own.
3. Roots. A run's root is such a Lyndon word under one of the two orders. It is extended both ways by longest common
   extensions (binary search on prefix hashes of the words, all roots of a stretch at once), and is a run if period and
   length fit. Each run is then checked word by word and, should a hash have deceived, extended word by word.

`periodic` plants faults as the query wants them. Null and empty texts have no words and no runs. Repeated rows get equal
results; an empty table gives no rows. Only the named columns are read. A text is worked on in one task, whole, in memory
that is linear in its words and time n log n.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import blank_null, mix64, pieces, text_bytes

LEAST = 12
PIECE = 256 << 10
BASE = np.uint64(0x9E3779B97F4A7C15)


def lyndon(sym: list[int]) -> list[int]:
    """The length of the longest Lyndon word from each place; symbols are 0, 1, ... without gaps. Baier's phase one."""
    n, kinds = len(sym), max(sym, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(kinds)]
    for i, s in enumerate(sym):
        members[s].append(i)
    group, context = list(sym), [1] * kinds
    below, above = list(range(-1, kinds - 1)), list(range(1, kinds + 1))  # neighbours in the order of groups
    above[-1:] = [-1] * (kinds > 0)
    left, done, out = [0] * n, bytearray(n), [0] * n
    g = kinds - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = []
        size = context[g]
        for i in own:
            done[i] = 1
            out[i] = size
        times: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and done[j] and group[j] != g:  # places of higher groups are jumped over
                j = left[j]
            if j >= 0 and done[j]:  # of the same group: its own answer, which is there already (places ascend)
                j = left[j]
            left[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        if times:
            fresh: dict[tuple[int, int], int] = {}
            for j, m in sorted(times.items(), key=lambda x: (-x[1], x[0])):
                h = group[j]
                new = fresh.get((h, m))
                if new is None:
                    new = fresh[h, m] = len(context)
                    context.append(context[h] + m * size)
                    members.append([])
                    up = above[h]  # right above h, under those with more repeats
                    above.append(up)
                    below.append(h)
                    above[h] = new
                    if up >= 0:
                        below[up] = new
                group[j] = new
                members[new].append(j)
        g = below[g]
    return out


class Prefixes:
    """Hashes of all substrings of a string of word numbers."""

    def __init__(self, sym: np.ndarray):
        n = len(sym)
        with np.errstate(over="ignore"):
            self.power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, BASE)]))
            # sum of word * BASE ** place; substrings are compared after aligning their powers
            self.sum = np.concatenate([[np.uint64(0)], np.add.accumulate(mix64(sym.astype(np.uint64) + np.uint64(1)) * self.power[:n])])
        self.n = n

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the substrings from a and from b (a < b) of the given size look equal."""
        with np.errstate(over="ignore"):
            return (self.sum[a + size] - self.sum[a]) * self.power[b - a] == self.sum[b + size] - self.sum[b]

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension to the right of places a < b."""
        return self._search(self.n - b, lambda size: self.same(a, b, size))

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension to the left, of the words before a and b."""
        return self._search(a.copy(), lambda size: self.same(a - size, b - size, size))

    @staticmethod
    def _search(most: np.ndarray, same) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) // 2
            ok = same(np.where(open_, mid, 0)) & open_
            low = np.where(ok, mid, low)
            high = np.where(open_ & ~ok, mid - 1, high)


def runs(sym: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least `least` words, by start, then period."""
    n = len(sym)
    if n < least:
        return []
    number = np.unique(sym, return_inverse=True)[1]
    top = int(number.max())
    found: set[tuple[int, int, int]] = set()
    prefixes = Prefixes(number)
    place = np.arange(n)
    for order in (number, top - number):
        period = np.array(lyndon(order.tolist()), np.int64)
        a, b = place, place + period
        fits = 2 * period <= n
        a, b, q = a[fits], b[fits], period[fits]
        inside = b < n
        ahead = np.zeros(len(a), np.int64)
        ahead[inside] = prefixes.ahead(a[inside], b[inside])
        behind = prefixes.behind(a, b)
        good = ahead + behind + q >= np.maximum(least, 2 * q)
        found |= set(zip((a - behind)[good].tolist(), (behind + q + ahead)[good].tolist(), q[good].tolist(), strict=True))
    return sorted(checked(number, found, least))


def checked(sym: np.ndarray, found: set[tuple[int, int, int]], least: int) -> set[tuple[int, int, int]]:
    """The runs, each of which holds word by word; one that a hash had extended too far is cut to the runs it holds."""
    out = set()
    for start, length, q in found:
        end = start + length
        equal = sym[start : end - q] == sym[start + q : end]
        if equal.all():
            out.add((start, length, q))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], equal.astype(np.int8), [0]])))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a + q >= max(least, 2 * q) and smallest_period(sym[start + a : start + b + q]) == q:
                out.add((start + a, b - a + q, q))
    return out


def smallest_period(sym: np.ndarray) -> int:
    return next(q for q in range(1, len(sym) + 1) if (sym[q:] == sym[: len(sym) - q]).all())


def stretches(number: np.ndarray, begin: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end of the maximal stretches of words that strings of `width` words cover which occur again in the same
    text (texts number[begin[i] : begin[i + 1]])."""
    n, none = len(number), np.zeros(0, np.int64)
    if n < width:
        return none, none
    size = np.diff(begin)
    text = np.repeat(np.arange(len(size)), size)
    at = np.flatnonzero(np.arange(n) + width <= begin[1:][text])
    if not len(at):
        return none, none
    with np.errstate(over="ignore"):
        code = mix64(text[at].astype(np.uint64))
        for j in range(width):
            code = mix64(code * BASE + number[at + j].astype(np.uint64) + np.uint64(1))
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    hit = at[again]
    if not len(hit):
        return none, none
    apart = np.concatenate([[True], (hit[1:] > hit[:-1] + width) | (text[hit[1:]] != text[hit[:-1]])])
    first = np.flatnonzero(apart)
    return hit[first], hit[np.append(first[1:], len(hit)) - 1] + width


def periodic(number: np.ndarray, doc_id) -> np.ndarray:
    """The places whose words the query's damaged text has: one in ten documents becomes periodic from a place on."""
    n = len(number)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    place = np.arange(n)
    if h % 10 or not n:
        return place
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place[a:] = a + (place[a:] - a) % p
    return place


def find(docs: DataFrame, keep: list[str], text_col: str = "text", least: int = LEAST, damage: str | None = None) -> DataFrame:
    """The columns `keep` of docs, n_runs, start, length, period, exponent_milli of the longest run (nulls without one),
    runs_sha256 (of `start,length,period` lines) and collapsed_sha256 (of the text without what repeats a run's first
    period), runs (all of them) and n_words. `damage` names the id column that `periodic` plants faults by."""
    marks = [F.col(damage).cast("string").alias("d")] if damage else []
    base = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], blank_null(text_col).alias("t"), *marks)
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "n_runs long, start long, length long, period long",
                        "exponent_milli long, runs_sha256 string, collapsed_sha256 string",
                        "runs array<struct<start:long,length:long,period:long>>, n_words long"])
    kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))

    def run(batches):
        for piece in pieces(batches, "t", PIECE):
            off, data = text_bytes(piece.column("t"))
            raw = data.tobytes()
            words: list[bytes] = []
            begin = [0]
            for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                words += raw[a:b].split()
                begin.append(len(words))
            known = {w: i for i, w in enumerate(dict.fromkeys(words))}
            number = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            if damage:
                for i, doc_id in enumerate(piece.column("d").to_pylist()):
                    a, b = begin[i], begin[i + 1]
                    place = periodic(number[a:b], doc_id)
                    if b > a and place[-1] != b - a - 1:
                        number[a:b] = number[a + place]
                        words[a:b] = [words[a + j] for j in place.tolist()]
            edges = np.array(begin, np.int64)
            of_text: dict[int, list[tuple[int, int, int]]] = {}
            for x, y in zip(*(e.tolist() for e in stretches(number, edges, least // 2)), strict=True):
                text = int(np.searchsorted(edges, x, side="right")) - 1
                more = [(x - begin[text] + s, n, q) for s, n, q in runs(number[x:y], least)]
                if more:
                    of_text.setdefault(text, []).extend(more)
            cols: list[list] = [[] for _ in range(9)]
            for i in range(piece.num_rows):
                own, mine = of_text.get(i, []), words[begin[i] : begin[i + 1]]
                best = max(own, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
                if own:
                    stay = np.ones(len(mine), bool)
                    for s, n, q in own:
                        stay[s + q : s + n] = False
                    mine = [w for w, ok in zip(mine, stay.tolist(), strict=True) if ok]
                lines = "".join(f"{s},{n},{q}\n" for s, n, q in own)
                row = (len(own), *best, 1000 * best[1] // best[2] if own else None, hashlib.sha256(lines.encode()).hexdigest(),
                       hashlib.sha256(b" ".join(mine)).hexdigest(), [dict(zip(("start", "length", "period"), r, strict=True)) for r in own],
                       begin[i + 1] - begin[i])
                for col, x in zip(cols, row, strict=True):
                    col.append(x)
            kinds = [*[pa.int64()] * 5, pa.string(), pa.string(), kind, pa.int64()]
            yield pa.RecordBatch.from_arrays([*(piece.column(f"k{i}") for i in range(len(keep))), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                                             names=[*keep, "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "n_words"])

    return base.mapInArrow(run, schema)
