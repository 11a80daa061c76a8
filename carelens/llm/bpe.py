"""Operator 5: byte-pair encoding and decoding with a contiguous rank array.

A word's parts (token ids between boundaries) lie in one contiguous row, beside them the merge rank of each adjacent
pair. The lowest rank of the row is found by scanning, its boundary is deleted (what follows moves one place left) and
the ranks left and right of it are read anew, until no pair of the row can be merged. Distinct short words of a batch
are the rows of one matrix, so that a scan serves all of them; words over LONG bytes, whose scans would take quadratic
time, use a heap of ranks instead. Results equal those of the public tokenizers library.

Null texts are empty; empty texts have no ids. Strings of added (special) tokens in a text become their id, as the
library does. Rows are independent: repeated rows give repeated results, an empty table an empty result, and further
columns are dropped by `encode` (which returns its id column and its own) whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.common import blank_null, pieces

#: Words of more bytes than this are merged with a heap.
LONG = 256
#: Words whose ids a worker remembers; beyond it, it forgets all and starts again.
REMEMBERED = 200_000
NONE = np.int32(2**31 - 1)


def byte_symbols() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable Latin-1 is itself, the other bytes
    follow in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def assigned(kind: str) -> str:
    """A class for \\p{kind} of the code points that this Python's Unicode tables assign (the pattern library's newer
    tables know more letters than the tokenizers library)."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    new = [ord(c) for c in regex.findall(rf"\p{{{kind}}}", every) if unicodedata.category(c) == "Cn"]
    runs, start = [], 0
    for i in range(1, len(new) + 1):
        if i == len(new) or new[i] != new[i - 1] + 1:
            runs.append(f"\\U{new[start]:08x}-\\U{new[i - 1]:08x}")
            start = i
    return f"[\\p{{{kind}}}--[{''.join(runs)}]]" if runs else f"\\p{{{kind}}}"


def word_pattern() -> str:
    """The split before merging: contractions, words, numbers and other runs with one blank before them, white space."""
    letter, number = assigned("L"), assigned("N")
    return rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?[^\s{letter}{number}]+|\s+(?!\S)|\s+"


#: Up to here the split's classes are written out, which the standard library's engine matches twice as fast.
COMMON = "\u024f"


def common_pattern() -> str:
    """`word_pattern` for texts without code points above COMMON."""
    every = "".join(map(chr, range(ord(COMMON) + 1)))

    def members(kind: str) -> str:
        return "".join(f"\\u{ord(c):04x}" for c in regex.findall(kind, every))

    letter, number, blank = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    return (rf" ?[{letter}]++|'(?:[stmd]|re|ve|ll)| ?[{number}]++| ?[^{blank}{letter}{number}]++"
            rf"|[{blank}]+(?![^{blank}])|[{blank}]+")


class PairTable:
    """Rank of a pair of ids: open addressing in arrays, probed for many pairs at once."""

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray):
        self.bits = max(4, int(len(pairs) * 4).bit_length())
        size = 1 << self.bits
        self.key, self.value = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        todo = np.arange(len(pairs))
        slot = self._slot(pairs)
        while len(todo):
            free = self.key[slot[todo]] == -1
            taker = np.unique(slot[todo[free]], return_index=True)[1]
            put = todo[free][taker]
            self.key[slot[put]], self.value[slot[put]] = pairs[put], ranks[put]
            todo = todo[self.key[slot[todo]] != pairs[todo]]
            slot[todo] = (slot[todo] + 1) & (size - 1)

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, pair: np.ndarray) -> np.ndarray:
        slot = self._slot(pair)
        key = self.key[slot]
        out = self.value[slot]
        other = np.flatnonzero((key != pair) & (key != -1))
        out[other] = NONE
        while len(other):
            slot[other] = (slot[other] + 1) & (len(self.key) - 1)
            key = self.key[slot[other]]
            hit = key == pair[other]
            out[other[hit]] = self.value[slot[other[hit]]]
            other = other[~hit & (key != -1)]
        return out


class Codec:
    """The vocabulary of a byte-level BPE file as arrays; small (a few MB) and fixed, so tasks get it with their code."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        if model["model"]["type"] != "BPE" or model.get("normalizer") or model["model"].get("ignore_merges"):
            raise ValueError("a byte-level BPE vocabulary without normalizer is needed")
        byte_of = byte_symbols()
        vocab: dict[str, int] = model["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        self.token_bytes = [b""] * (1 + max([*vocab.values(), *self.added.values()]))
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(byte_of[c] for c in token) if token not in self.added else token.encode()
        for token, i in self.added.items():
            self.token_bytes[i] = token.encode()
        self.byte_ids = np.zeros(256, np.int32)
        for c, b in byte_of.items():
            self.byte_ids[b] = vocab[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        pair = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        first = np.sort(np.unique(pair, return_index=True)[1])  # a pair listed twice keeps its last rank, as in a map
        rank = {int(p): r for r, p in enumerate(pair)}
        order = np.argsort(pair[first], kind="stable")
        self.pairs = pair[first][order]
        self.ranks = np.array([rank[int(p)] for p in self.pairs], np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)  # by rank
        self.table = PairTable(self.pairs, self.ranks)
        self.pattern, self.common = word_pattern(), common_pattern()
        self.split_added = "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.table.get((left.astype(np.int64) << 32) | right)

    def merge_short(self, words: list[bytes]) -> list[list[int]]:
        """The ids of words of at most LONG bytes: rows of one matrix per width."""
        out: list[list[int]] = [[]] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        low = 0
        for width in (4, 8, 16, 32, 64, LONG):
            which = np.flatnonzero((size > low) & (size <= width))
            low = width
            for i in range(0, len(which), 1 << 16):
                self._merge_rows(words, which[i : i + (1 << 16)], size, width, out)
        return out

    def _merge_rows(self, words, which, size, width, out) -> None:
        if not len(which):
            return
        n = size[which]
        flat = self.byte_ids[np.frombuffer(b"".join(words[i] for i in which), np.uint8)]
        inside = np.arange(width) < n[:, None]
        ids = np.full((len(which), width), -1, np.int32)
        ids[inside] = flat
        ranks = np.full((len(which), width), NONE, np.int32)  # ranks[:, j]: of parts j and j + 1
        if width > 1:
            ok = inside[:, 1:]
            ranks[:, :-1][ok] = self.rank_of(ids[:, :-1][ok], ids[:, 1:][ok])
        column = np.arange(width, dtype=np.int16)
        while len(which):
            at = ranks.argmin(axis=1)
            row = np.arange(len(which))
            best = ranks[row, at]
            over = best == NONE
            if over.any():
                for r in np.flatnonzero(over):
                    out[which[r]] = ids[r, : n[r]].tolist()
                keep = ~over
                which, n, ids, ranks, at, best = which[keep], n[keep], ids[keep], ranks[keep], at[keep], best[keep]
                row = np.arange(len(which))
                if not len(which):
                    return
                column = np.arange(int(n.max()), dtype=np.int16)
                ids, ranks = ids[:, : len(column)], ranks[:, : len(column)]
            # delete the boundary between parts `at` and `at + 1`: later places move one to the left
            later = column[:-1] > at.astype(np.int16)[:, None]
            ids[:, :-1] = np.where(later, ids[:, 1:], ids[:, :-1])
            ranks[:, :-1] = np.where(later, ranks[:, 1:], ranks[:, :-1])
            ids[row, at] = self.made[best]
            n = n - 1
            ranks[:, -1] = NONE
            left = at > 0
            ranks[row[left], at[left] - 1] = self.rank_of(ids[row[left], at[left] - 1], ids[row[left], at[left]])
            right = at + 1 < n
            ranks[row[right], at[right]] = self.rank_of(ids[row[right], at[right]], ids[row[right], at[right] + 1])
            ranks[row[~right], at[~right]] = NONE

    def merge_long(self, word: bytes) -> list[int]:
        """The same merges with a heap of (rank, place) and links between the parts: n log n for a long word."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.rank_of(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        known = self._pair_rank()
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[r]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (q := known.get((ids[k] << 32) | ids[after[k]])) is not None:
                    heapq.heappush(heap, (q, k, ids[k], ids[after[k]]))
        return [t for t in ids if t >= 0]

    def _pair_rank(self) -> dict[int, int]:
        if not hasattr(self, "_known"):
            self._known = dict(zip(self.pairs.tolist(), self.ranks.tolist(), strict=True))
        return self._known

    def merge(self, words: list[bytes]) -> list[list[int]]:
        short = self.merge_short([w if len(w) <= LONG else b"" for w in words])
        return [self.merge_long(w) if len(w) > LONG else ids for w, ids in zip(words, short, strict=True)]

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


class Encoder:
    """A codec with its compiled split and the words it remembers, one per Python worker task."""

    def __init__(self, codec: Codec):
        self.codec, self.find_any, self.find_common = codec, regex.compile(codec.pattern).findall, re.compile(codec.common).findall
        self.uncommon = re.compile(f"[^\0-{COMMON}]").search
        self.special = regex.compile(f"({codec.split_added})") if codec.added else None
        self.known: dict[str, list[int]] = {}

    def find(self, text: str) -> list[str]:
        return self.find_any(text) if self.uncommon(text) else self.find_common(text)

    def words(self, text: str) -> list[str]:
        """The words of a text; an added token is a word of its own."""
        if self.special is None or not self.special.search(text):
            return self.find(text)
        out: list[str] = []
        for i, part in enumerate(self.special.split(text)):
            out += [part] if i % 2 else self.find(part)
        return out

    def ids(self, words) -> dict[str, list[int]]:
        """The ids of the distinct words: those remembered, and the others merged together."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        known, out = self.known, {}
        new = []
        for w in words:
            got = known.get(w)
            if got is None:
                new.append(w)
            else:
                out[w] = got
        plain = [w for w in new if w not in self.codec.added]
        found = dict(zip(plain, self.codec.merge([w.encode() for w in plain]), strict=True))
        found |= {w: [self.codec.added[w]] for w in new if w in self.codec.added}
        known.update((w, found[w]) for w in new[: REMEMBERED // 2])
        return out | found


def encode(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: the id column, and `ids` (array of int) of the whole text. spec: the vocabulary file's
    text (see `read_spec`)."""
    codec = Codec(spec)
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids array<int>"

    def run(batches):
        enc = Encoder(codec)
        for batch in pieces(batches, "t"):
            split = [enc.words(t) for t in batch.column("t").to_pylist()]
            known = enc.ids({w for words in split for w in words})
            ids = [[i for w in words for i in known[w]] for words in split]
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(ids, pa.list_(pa.int32()))],
                                             names=[id_col, "ids"])

    return docs.select(F.col(id_col).alias("i"), blank_null(text_col).alias("t")).mapInArrow(run, schema)


def decode(encoded: DataFrame, spec: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The id column and `text`, decoded from the ids (invalid UTF-8 becomes U+FFFD; null ids give empty text)."""
    codec = Codec(spec)
    schema = f"`{id_col}` {encoded.schema[id_col].dataType.simpleString()}, text string"

    def run(batches):
        for batch in batches:
            text = [codec.decode(ids or []) for ids in batch.column("x").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(text, pa.string())], names=[id_col, "text"])

    return encoded.select(F.col(id_col).alias("i"), F.col(ids_col).alias("x")).mapInArrow(run, schema)


def digests(docs: DataFrame, spec: str, keep: list[str], text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass: the columns `keep` and, per text, n_tokens, ids_sha256 (of the decimal ids
    joined by commas) and decoded_sha256; and `ids` only if asked for, as they are larger than the text."""
    codec = Codec(spec)
    base = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], blank_null(text_col).alias("t"))
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*kinds, "n_tokens long, ids_sha256 string, decoded_sha256 string",
                        *["ids array<int>"] * with_ids])

    def run(batches):
        enc = Encoder(codec)
        sha = hashlib.sha256
        for batch in pieces(batches, "t"):
            split = [enc.words(t) for t in batch.column("t").to_pylist()]
            known = enc.ids({w for words in split for w in words})
            decimal = {w: ",".join(map(str, ids)) for w, ids in known.items()}
            back = {w: codec.decode_bytes(ids) for w, ids in known.items()}
            n, of_ids, of_text = [], [], []
            for words in split:
                line = ",".join(map(decimal.__getitem__, words))
                n.append(line.count(",") + 1 if line else 0)
                of_ids.append(sha(line.encode()).hexdigest())
                text = b"".join(map(back.__getitem__, words)).decode("utf-8", "replace")
                of_text.append(sha(text.encode()).hexdigest())
            done = [pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            if with_ids:
                flat = np.fromiter((i for words in split for w in words for i in known[w]), np.int32, sum(n))
                done.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), pa.array(flat)))
            yield pa.RecordBatch.from_arrays([*(batch.column(f"k{i}") for i in range(len(keep))), *done],
                                             names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids])

    return base.mapInArrow(run, schema)


def read_spec(spark: SparkSession, path: str | None = None) -> str:
    """The vocabulary file's text, read once on the driver (fixed size). The default is the installed public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()
