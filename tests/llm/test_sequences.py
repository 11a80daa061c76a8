"""Operators 11 to 13 against brute force: on the driver's small tables and on edge rows."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from carelens.llm import conversations, runs, simhash
from carelens.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.test_operators import EXTRA, LONG, ROWS, prose

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


def documents(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in [*EXTRA, "fp", "i", "v", "half", "d", "runs", "length"] if c not in ("lang",)][:18])


def ordered(rows):
    return sorted(rows, key=lambda x: tuple((y is not None, y) for y in x))


def read(name, columns, sf=SMALL):
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/{name}.parquet'").fetchall()


# ---- runs


def naive_lyndon(s):
    return [max(m for m in range(1, len(s) - i + 1) if all(s[i : i + m] < s[i + k : i + m] for k in range(1, m))) for i in range(len(s))]


def test_lyndon_arrays():
    rnd = random.Random(1)
    for _ in range(800):
        s = [rnd.randrange(rnd.randint(1, 4)) for _ in range(rnd.randint(1, 18))]
        s = [sorted(set(s)).index(x) for x in s]
        assert runs.lyndon(s) == naive_lyndon(s)
    assert runs.lyndon([]) == [] and runs.lyndon([0] * 1000) == [1] * 1000


def periodic_texts(n):
    rnd = random.Random(2)
    out = []
    for i in range(n):
        w = []
        while len(w) < rnd.randint(0, 160):
            if w and rnd.random() < 0.5:
                w += w[-rnd.randint(1, min(25, len(w))) :] * rnd.randint(1, 5)
            else:
                w += [rnd.choice("abcde") if i % 2 else str(rnd.randrange(300)) for _ in range(rnd.randint(1, 9))]
        out.append((i, rnd.choice((" ", "\n", " \t ")).join(w)))
    return out


def test_runs_on_periodic_and_edge_texts(spark):
    rows = [r for r in ROWS if r[1] is not LONG] + periodic_texts(250) + [(7000, "a " * 3000 + "b"), (7001, prose(1, 400) + " tail " + prose(1, 400))]
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = runs.find(documents(spark, rows), keep=["doc_id", "k"], damage="doc_id")
    assert got.columns == ["doc_id", "k", *names, "runs", "n_words"]
    assert ordered(tuple(r[c] for c in ("doc_id", *names)) for r in got.collect()) == ordered((i, *brute.word_runs(i, t)) for i, t in rows)
    none = documents(spark, rows).limit(0)
    assert runs.find(none, keep=["doc_id"]).count() == 0


def test_runs_of_a_very_long_text(spark):
    text = " ".join(["x y z"] * 150_000) + " " + LONG
    row = runs.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), keep=["doc_id"]).first()
    assert (row.n_runs, row.start, row.length, row.period) == (1, 0, 450_000, 3)
    assert row.collapsed_sha256 == brute.sha(" ".join(["x y z", *LONG.split()]))


def test_runs_recover_from_deceiving_hashes(monkeypatch):
    monkeypatch.setattr(runs.Prefixes, "same", lambda self, a, b, size: np.ones(len(a), bool))
    assert {q for _, _, q in runs.runs(np.array([*range(30), *[7, 8] * 10, *range(40, 60)]))} <= {2}


def test_runs_query(spark):
    want = ordered((i, *brute.word_runs(i, t)) for i, t in read("documents", "doc_id, text"))
    assert ordered(tuple(r) for r in QUERIES["op11_runs"](spark, SMALL).collect()) == want


# ---- simhash


def test_simhash_edges(spark):
    rows = [*ROWS, (20, None), (21, prose(1, 120)), (22, prose(1, 120) + " end"), (None, "")]
    got = simhash.classes(documents(spark, rows))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert ordered(tuple(r) for r in got.collect()) == ordered((i, *x) for (i, _), x in zip(rows, brute.hamming_classes(rows), strict=True))
    assert simhash.classes(documents(spark, rows).limit(0)).count() == 0


def test_simhash_query(spark):
    rows = read("documents", "doc_id, text", MIDDLE)
    want = ordered((i, *x) for (i, _), x in zip(rows, brute.hamming_classes(rows), strict=True))
    assert ordered(tuple(r) for r in QUERIES["op12_simhash"](spark, MIDDLE).collect()) == want


@pytest.mark.parametrize("hot", [50, simhash.HOT])
def test_links_are_complete_in_dense_buckets(spark, hot):
    """Chains and balls of fingerprints around a few centres, all of which share 32-bit halves; also with buckets split."""
    rnd = random.Random(3)
    fps = {0, 2**64 - 1}
    for _ in range(4):
        centre = rnd.getrandbits(64)
        for _ in range(350):
            x = centre
            for b in rnd.sample(range(rnd.choice((0, 0, 32)), 64), rnd.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
            centre = x if rnd.random() < 0.1 else centre
    fps |= {rnd.getrandbits(64) for _ in range(300)}
    signed = sorted(x - 2**64 if x >= 2**63 else x for x in fps)
    ties = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), hot).collect()
    root = {x: x for x in signed}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for t in ties:
        assert ((t.a ^ t.b) & (2**64 - 1)).bit_count() <= 3
        root[top(t.a)] = top(t.b)
    array = np.array(signed, np.int64).view(np.uint64)
    for x in signed:
        for y in array[np.bitwise_count(array ^ np.int64(x).view(np.uint64)) <= 3].view(np.int64).tolist():
            assert top(x) == top(y)
    assert len(ties) < 34 * 4 * len(signed)


def test_simhash_hot_template(spark):
    """20,000 fingerprints in one ball: ties stay linear."""
    fps = [(a << 32 | b) for a in range(1) for b in range(20_000)]
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    assert simhash.links(df, 2000).count() < 100 * len(fps)


# ---- conversations

TEXTS = ["Hi there.", "Why?", "No end", "", " \t", "Well!", "a.b", "ends. ", None, "off", "f", "so. f", "b.\u000b", "\u000c", "c!\r\n"]


def chats(n, seed=4, most=9):
    rnd = random.Random(seed)
    out = []
    for c in range(n):
        for t in range(rnd.randint(1, most)):
            turn = None if rnd.random() < 0.05 else t + (rnd.random() < 0.1) * 3
            out.append((c, turn, rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rnd.choice(TEXTS)))
    return out


def conversation_rows(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    return df.select("*", *[F.lit(1).alias(x) for x in ("c", "t", "d", "h", "copies", "audit", "code", "first", "m")])


COLUMNS = ["conv_id", *conversations.COUNTS, "audit", "repaired_sha256"]


def test_conversations_on_edge_rows(spark):
    rows = [*chats(600), (None, 0, "user", "x."), (None, None, "user", "x."), (9000, 1, None, None), (9001, 5, "assistant", "?")]
    rows += rows[:80]  # repeated rows
    got = conversations.repaired(conversations.damaged(conversation_rows(spark, rows)))
    assert got.columns == COLUMNS
    assert ordered(tuple(r) for r in got.collect()) == ordered((c, *x) for c, x in brute.conversation_repairs(rows).items())
    assert conversations.repaired(conversations.damaged(conversation_rows(spark, rows).limit(0))).count() == 0


def test_conversations_undamaged(spark):
    rows = chats(100, seed=5)
    got = conversations.repaired(conversations.whole(conversation_rows(spark, rows)))
    want = brute.conversation_repairs(rows, lambda rs: [(c, t, *(" " if x is None else x for x in r)) for c, t, *r in rs])
    assert ordered(tuple(r) for r in got.collect()) == ordered((c, *x) for c, x in want.items())


def test_hirschberg_equals_search_on_one_long_conversation(spark, monkeypatch):
    """One conversation with most rows, in many pieces."""
    monkeypatch.setattr(conversations, "PIECE_ROWS", 40)
    rnd = random.Random(6)
    rows = [(1, t // 2, rnd.choice(["user", "assistant", "system"]), f"{rnd.randrange(200)}{rnd.choice('. ?')}") for t in range(900)] + chats(20)
    got = conversations.repaired(conversations.damaged(conversation_rows(spark, rows)))
    assert ordered(tuple(r) for r in got.collect()) == ordered((c, *x) for c, x in brute.conversation_repairs(rows).items())


def test_a_long_conversation_is_repaired_in_linear_space():
    rnd = random.Random(7)
    cost, audit = conversations.Repairer().repair(bytes(rnd.randrange(conversations.CODES) for _ in range(200_000)))
    assert cost > 0 and len(audit) >= 200_000


def test_conversations_query(spark):
    want = ordered((c, *x) for c, x in brute.conversation_repairs(read("conversations", "conv_id, turn, role, text", MIDDLE)).items())
    assert ordered(tuple(r) for r in QUERIES["op13_conversations"](spark, MIDDLE).collect()) == want
