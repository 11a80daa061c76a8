"""Operator 2: language identification by interpolated Kneser-Ney character language models.

Texts become letters (lower-cased) and single blanks for everything else; a model of ORDER characters is estimated per
language with absolute discounts and continuation counts. It learns from a sample: at most `per_lang` labelled documents
of each language (those whose ids hash lowest) and `sample_chars` characters of each, in that order; both are parameters. The models
of all languages share sorted arrays of 64-bit n-gram hashes with one column of log probabilities per language, so an
n-gram is looked up once for all; an n-gram that is missing backs off through context weights kept the same way.

A text gets the language with the lowest cross-entropy per character. `score` is that language's probability among all,
with a temperature calibrated on a fifth of the sample that the counts leave out; `rejected` says that even the best
cross-entropy is above the median of the language's own calibration documents by a margin that widens for short texts.
The median stays where it is when some of them are odd or mislabelled. A
language with fewer than ENOUGH of them has the limit of the other languages' documents together.

Null texts and texts without a letter have lang_pred `und`, score 0 and are rejected; so is every text when no language
was learned. Ties go to the language that sorts first. Repeated rows get equal results; an empty table gives no rows. Texts of
any length are predicted whole, one that is longer than a piece by itself.
Only the named columns are read, and only labels outside the held-out fold are learned from.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import blank_null, fold_of, mix64, pieces

ORDER, UNKNOWN = 4, "und"
BLANK = 32
#: Calibration documents of 100 symbols or more from which a language has a rejection limit of its own.
ENOUGH = 5
#: Nats a symbol above their median that a text is still taken for the language with, and what is added over sqrt(symbols).
MARGIN, SHORT = 0.6, 10.0
#: Slices of a language's documents (by other bits of the hash that orders them) from which its sample comes.
SLICES = 16
#: Bytes of text that a task predicts at once: n-grams take some fifty times as much.
PIECE = 256 << 10
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """By code point: the lower-case letter as a 16-bit symbol, or a blank. Letters beyond 16 bits are folded in."""
    if not _LETTERS:
        fold = np.full(0x110000, BLANK, np.uint64)
        for c in range(0x110000):
            if chr(c).isalpha():
                low = chr(c).lower()
                c2 = ord(low) if len(low) == 1 else c
                fold[c] = c2 if c2 < 0x10000 else 0xE000 + c2 % 0x1900  # the private-use area has no letters
        _LETTERS.append(fold)
    return _LETTERS[0]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts as symbols one after another, ORDER - 1 blanks before each so that no n-gram reaches into another text;
    where each begins (with its blanks), and which symbols are not those blanks."""
    gap = ORDER - 1
    code = np.frombuffer("".join(["\0" * gap + t for t in texts]).encode("utf-32-le", "replace"), np.uint32)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.concatenate([[0], np.cumsum(size + gap)[:-1]])
    sym = letters()[code]
    own = np.ones(len(sym), bool)
    for j in range(gap):
        own[begin + j] = False
    keep = (sym != BLANK) | ~own
    keep[1:] |= sym[:-1] != BLANK
    return sym[keep], np.cumsum(keep)[begin] - 1, own[keep]


def grams(sym: np.ndarray, n: int) -> np.ndarray:
    """The n symbols that end at each place (the first n - 1 places reach before the beginning: blanks)."""
    out = sym.copy()
    for j in range(1, n):
        out[j:] |= sym[:-j] << np.uint64(16 * j)
        out[:j] |= np.uint64(BLANK) << np.uint64(16 * j)
    return out


class HashTable:
    """Sorted hashes with rows of numbers; a table of the hashes' high bits says where to begin."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        hashes = mix64(keys)
        order = np.argsort(hashes)
        self.hashes, self.rows = hashes[order], rows[order].astype(np.float32)
        self._index()

    def _index(self) -> None:
        self.bits = max(1, int(len(self.hashes) * 2).bit_length())
        edges = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.begin = np.searchsorted(self.hashes, edges).astype(np.int32)
        held = np.diff(np.append(self.begin, len(self.hashes)))
        self.most = int(held.max()) if len(held) else 0
        self.padded = np.append(self.hashes, np.uint64(2**64 - 1))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row number of each key, or -1."""
        h = mix64(keys)
        at = self.begin[(h >> np.uint64(64 - self.bits)).astype(np.int64)]
        found = self.padded[at] == h
        for _ in range(self.most):
            todo = np.flatnonzero(self.padded[at] < h)
            if not len(todo):
                break
            at[todo] += 1
            found[todo] = self.padded[at[todo]] == h[todo]
        return np.where(found & (at < len(self.hashes)), at, -1)

    def arrays(self, name: str) -> dict:
        return {f"{name}_h": self.hashes, f"{name}_r": self.rows}

    @classmethod
    def of_arrays(cls, z, name: str) -> HashTable:
        out = cls.__new__(cls)
        out.hashes, out.rows = z[f"{name}_h"], z[f"{name}_r"]
        out._index()
        return out


class Models:
    """Interpolated Kneser-Ney models of several languages."""

    def __init__(self, langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        """counts: per language the distinct n-grams of ORDER symbols and how often each occurs."""
        self.langs = langs
        mask = [np.uint64((1 << (16 * n)) - 1) for n in range(ORDER + 1)]
        every = [None] * (ORDER + 1)  # by order: n-grams and counts (continuation counts below ORDER) per language
        every[ORDER] = counts
        for n in range(ORDER - 1, 0, -1):
            every[n] = [np.unique(keys & mask[n], return_counts=True) for keys, _ in every[n + 1]]
        self.prob: list[HashTable | None] = [None] * (ORDER + 1)  # log p of n-grams
        self.back: list[HashTable | None] = [None] * (ORDER + 1)  # log weight of the shorter n-gram, by context
        alphabet = max(2, len(np.unique(np.concatenate([k for k, _ in every[1]]))) + 1)
        self.floor = np.log(np.full(len(langs), 1.0 / alphabet, np.float32))
        for n in range(1, ORDER + 1):
            keys = np.unique(np.concatenate([k for k, _ in every[n]]))
            contexts = np.unique(np.concatenate([k >> np.uint64(16) for k, _ in every[n]]))
            prob, back = np.zeros((len(keys), len(langs))), np.zeros((len(contexts), len(langs)))
            for l, (own, c) in enumerate(every[n]):
                once, twice = (c == 1).sum(), (c == 2).sum()
                discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once + twice else 0.5
                ctx, which = np.unique(own >> np.uint64(16), return_inverse=True)
                total = np.bincount(which, weights=c, minlength=len(ctx))
                kinds = np.bincount(which, minlength=len(ctx))
                back[np.searchsorted(contexts, ctx), l] = np.log(discount * kinds / total)
                prob[np.searchsorted(keys, own), l] = np.maximum(c - discount, 0) / total[which]
            self.back[n] = HashTable(contexts, back)
            lower = np.exp(self._lower(keys, n).astype(np.float64))
            self.prob[n] = HashTable(keys, np.log(prob + lower))

    def _lower(self, keys: np.ndarray, n: int) -> np.ndarray:
        """log of back-off weight times the shorter n-gram's probability."""
        at = self.back[n].find(keys >> np.uint64(16))
        weight = np.where(at[:, None] >= 0, self.back[n].rows[at], np.float32(0))
        if n == 1:
            return weight + self.floor
        return weight + self.log_prob(keys & np.uint64((1 << (16 * (n - 1))) - 1), n - 1)

    def log_prob(self, keys: np.ndarray, n: int = ORDER) -> np.ndarray:
        """log p of each n-gram's last symbol after the others, a column per language."""
        at = self.prob[n].find(keys)
        out = self.prob[n].rows[at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            out[miss] = self._lower(keys[miss], n)
        return out

    def entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: nats per symbol of each language, the number of symbols, and whether there is a letter."""
        sym, begin, own = symbols(texts)
        logs = self.log_prob(grams(sym, ORDER))
        logs[~own] = 0
        total = np.add.reduceat(logs, begin, axis=0, dtype=np.float64)
        n = np.maximum(np.add.reduceat(own.astype(np.int64), begin), 1)
        lettered = np.add.reduceat((sym != BLANK).astype(np.int64), begin) > 0
        return -total / n[:, None], n, lettered

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: the language's number (-1: none), its calibrated probability, and whether it is rejected."""
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool)
        entropy, n, lettered = self.entropy(texts)
        best = entropy.argmin(axis=1)
        lowest = entropy[np.arange(len(best)), best]
        gap = -(entropy - lowest[:, None]) * np.minimum(n, 200)[:, None] * self.sharpness
        score = 1.0 / np.exp(gap).sum(axis=1)
        rejected = lowest > self.limit[best] + self.spread[best] / np.sqrt(n)
        return np.where(lettered, best, -1), np.where(lettered, score, 0.0), rejected | ~lettered

    def calibrate(self, texts: list[str], truth: np.ndarray) -> None:
        """The temperature with the best log likelihood, and each language's median entropy with margins."""
        self.sharpness = 1.0
        # without any calibration document: no better than letters by chance
        self.limit, self.spread = -self.floor.astype(np.float64), np.full(len(self.langs), SHORT)
        if not texts:
            return
        entropy, n, _ = self.entropy(texts)
        own = entropy[np.arange(len(truth)), truth]
        best = -np.inf
        for sharpness in (0.02, 0.05, 0.1, 0.2, 0.5, 1.0):
            z = -entropy * np.minimum(n, 200)[:, None] * sharpness
            z -= z.max(axis=1, keepdims=True)
            fit = (z[np.arange(len(truth)), truth] - np.log(np.exp(z).sum(axis=1))).sum()
            if fit > best:
                best, self.sharpness = fit, sharpness
        mine = [own[(truth == l) & (n >= 100)] for l in range(len(self.langs))]
        # a language with few calibration documents has the limit of the others' documents together
        pooled = np.concatenate([x for x in mine if len(x) >= ENOUGH] or mine)
        for l in range(len(self.langs)):
            use = mine[l] if len(mine[l]) >= ENOUGH else pooled
            if len(use):
                self.limit[l] = np.median(use) + MARGIN

    def dump(self) -> bytes:
        out = {"langs": np.array(self.langs), "floor": self.floor, "sharpness": np.array(self.sharpness),
               "limit": self.limit, "spread": self.spread}
        for n in range(1, ORDER + 1):
            out |= self.prob[n].arrays(f"p{n}") | self.back[n].arrays(f"b{n}")
        file = io.BytesIO()
        np.savez(file, **out)
        return file.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Models:
        z = np.load(io.BytesIO(raw), allow_pickle=False)
        out = cls.__new__(cls)
        out.langs, out.floor, out.sharpness = [str(x) for x in z["langs"]], z["floor"], float(z["sharpness"])
        out.limit, out.spread = z["limit"], z["spread"]
        out.prob = [None, *(HashTable.of_arrays(z, f"p{n}") for n in range(1, ORDER + 1))]
        out.back = [None, *(HashTable.of_arrays(z, f"b{n}") for n in range(1, ORDER + 1))]
        return out


def learn(texts: list[str], langs: list[str], sample_chars: int) -> Models | None:
    """Models of the languages of a sample; every fifth document of a language calibrates. Of a document longer than what is
    left of sample_chars the beginning is learned. A language without a symbol to learn from is left out."""
    names, counts, held, truth = [], [], [], []
    for name in sorted(set(langs)):
        room, own, tested = sample_chars, [], []
        for i, t in enumerate(t for t, x in zip(texts, langs, strict=True) if x == name):
            if i % 5 == 4:
                tested.append(t[:room])
            else:
                own.append(t[:room])
            room -= min(room, len(t))
        if not any(own):
            continue
        sym, _, real = symbols(own)
        if not real.any():
            continue
        counts.append(np.unique(grams(sym, ORDER)[real], return_counts=True))
        held += tested
        truth += [len(names)] * len(tested)
        names.append(name)
    if not names:
        return None
    out = Models(names, counts)
    out.calibrate(held, np.array(truth, np.int64))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 1000,
          sample_chars: int = 5_000_000, folds: int = 4, held_out: int = 2) -> bytes:
    """The trained models (`Models.dump`; empty if there is nothing to learn from). Fitted in one task on the bounded
    sample, whose ids are broadcast (languages times per_lang rows), so no documents are shuffled but the sample's own."""
    known = (docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()
                        & (fold_of(id_col, folds) != held_out))
             .select(F.col(id_col).alias("s_id"), F.col(lang_col).cast("string").alias("s_lang")).withColumn("h", F.xxhash64("s_id")))
    # the lowest hashes of each of SLICES slices of a language first, so that no task sorts all rows of one
    each = max(1, 2 * per_lang // SLICES)
    in_slice, first = (Window.partitionBy("s_lang", *c).orderBy("h", "s_id") for c in (["slice"], []))
    few = known.withColumn("slice", F.pmod(F.shiftright("h", 8), F.lit(SLICES))).withColumn("n", F.row_number().over(in_slice)).where(F.col("n") <= each)
    ids = few.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_lang).select("s_id", "s_lang", "h").distinct()
    sample = (docs.select(F.col(id_col).alias("d_id"), F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("d_lang"))
              .join(F.broadcast(ids), (F.col("d_id") == F.col("s_id")) & (F.col("d_lang") == F.col("s_lang")))
              .where(F.col("t").isNotNull()).select("t", F.col("d_lang").alias("y"), "h").repartition(1).sortWithinPartitions("h", "t"))

    def run(frames):
        texts, langs = [], []
        for frame in frames:
            texts += frame["t"].tolist()
            langs += frame["y"].tolist()
        model = learn(texts, langs, sample_chars)
        yield pd.DataFrame({"model": [model.dump() if model else b""]})

    row = sample.mapInPandas(run, "model binary").first()
    return bytes(row["model"]) if row else b""


def identify(docs: DataFrame, model: bytes, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep`, and lang_pred, score and rejected, of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], blank_null(text_col).alias("t"))
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep),
                        "lang_pred string, score double, rejected boolean"])

    def run(batches):
        models = Models.load(shared.value) if shared.value else None
        for batch in pieces(batches, "t", PIECE):
            texts = batch.column("t").to_pylist()
            if models:
                best, score, rejected = models.predict(texts)
                lang = [models.langs[b] if b >= 0 else UNKNOWN for b in best]
            else:
                lang, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f"k{i}") for i in range(len(keep))), pa.array(lang, pa.string()),
                 pa.array(score, pa.float64()), pa.array(rejected)], names=[*keep, "lang_pred", "score", "rejected"])

    return base.mapInArrow(run, schema)
