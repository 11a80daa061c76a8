"""The operators on edge rows: nulls, empty and long texts, repeated rows, empty tables, columns with clashing names."""

import collections
import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carelens.llm import bpe, decontaminate, fingerprints, hmm, langid, neardup, quality, suffixes, toxicity, urls
from carelens.llm.common import fold_of
from tests.llm import brute

VOCABULARY = ("the of and to in a is was for on with by this that are as it from or an be at not have which "
              "one all were their has been more will can when there").split()


def prose(seed, n):
    rnd = np.random.default_rng(seed)
    return " ".join(VOCABULARY[i] + str(rnd.integers(40)) for i in rnd.integers(len(VOCABULARY), size=n))


PASSAGE = prose(99, 80)
LONG = prose(7, 60_000)
ROWS = [
    (1, prose(1, 120)), (2, None), (3, ""), (4, " \t\n "), (None, prose(2, 60)), (5, LONG), (6, prose(3, 30)), (6, prose(4, 30)),
    (7, prose(5, 90)), (7, prose(5, 90)), (8, "日本語 Éa ÀB <|endoftext|> x y"), (9, prose(6, 50) + " " + PASSAGE), (10, PASSAGE + " " + prose(8, 40)),
    (11, "One"), (12, "one"), (13, prose(9, 200)), (14, prose(9, 200).replace(" ", "  ", 3) + " tail"), (15, "A" * 3000), (16, "ab " * 900),
    (17, PASSAGE.upper()), (18, prose(10, 1) + "!"), (19, "12 345 ..."),
]
EXTRA = "k t i n s h r f c words item start row fp ctx lang label y root shard block turn e q m".split()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in EXTRA if c != "lang"], F.lit("en").alias("lang"))


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def by_row(df, *cols):
    """Sorted results by id (null first); equal ids in the order of the other columns."""
    return sorted((tuple(r[c] for c in ("doc_id", *cols)) for r in df.collect()), key=lambda x: tuple((y is not None, y) for y in x))


def ordered(rows):
    return sorted(rows, key=lambda x: tuple((y is not None, y) for y in x))


def test_hmm_base_and_model(docs, none):
    got = hmm.score(docs, fold_of("doc_id", 5) != 1)
    want = brute.base_scores(ROWS, lambda i: brute.fold(i, 5) != 1)
    a = by_row(got, "n_tokens", "n_known", "train_tokens", "base_score", "score")
    b = ordered([(i, *w) for (i, _), w in zip(ROWS, want, strict=True)])
    assert [x[:4] for x in a] == [x[:4] for x in b]
    assert np.allclose([x[4] for x in a], [x[4] for x in b])
    assert all(x[5] < 0 for x in a)
    assert hmm.score(none, F.lit(True)).count() == 0
    nothing = hmm.score(docs, F.lit(False)).collect()
    assert {(r.score, r.base_score, r.n_known, r.train_tokens) for r in nothing} == {(0.0, 0.0, 0, 0)}


def plain_scores(rows, learn, p, class_tokens):
    """log10 likelihoods of whole texts by a model's parameters, token by token."""
    import xxhash

    tokens = [[*brute.blank_words(t), ""] for _, t in rows]
    counts = collections.Counter(x for (i, _), w in zip(rows, tokens, strict=True) if learn(i) for x in w)
    n, once = sum(counts.values()), sum(c == 1 for c in counts.values())
    unknown = max(once, 0.5) / (n + 1)
    out = []
    for w in tokens:
        alpha, log = p.start, 0.0
        for t, x in enumerate(w):
            cls = hmm.END if x == "" else xxhash.xxh3_64_intdigest(x.encode()) % (hmm.CLASSES - 1) + 1
            alpha = alpha @ p.move if t else alpha
            if counts[x]:
                alpha = alpha * p.emit[cls]
                log += math.log10(counts[x] / class_tokens[cls] * (1 - unknown))
            else:
                log += math.log10(unknown)
            log += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        out.append(log)
    return out


def test_hmm_scores_equal_a_plain_recursion(spark):
    rows = [(i, prose(i, 5 + i)) for i in range(40)] + [(90, None), (91, "unheard of"), (92, prose(3, 3000))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    learn = F.col("doc_id") % 5 != 1
    table = hmm.written(hmm.blocks(df, "doc_id", "text", learn), "test_blocks")
    p = hmm.first_parameters(table, 10**4, 500_000, 25)
    for _ in range(3):
        p, class_tokens, _ = hmm.baum_welch(table, p)
    got = [s for _, s in by_row(hmm.score(df, learn), "score")]
    assert np.allclose(got, plain_scores(rows, lambda i: i % 5 != 1, p, class_tokens), rtol=1e-5)


def test_hmm_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    rows = [(i, prose(i, 20 + i % 60)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = by_row(hmm.score(df.repartition(1), F.col("doc_id") % 5 != 1, sample_tokens=3000), "score")
    seven = by_row(hmm.score(df.repartition(7, "text"), F.col("doc_id") % 5 != 1, sample_tokens=3000), "score")
    assert np.allclose([s for _, s in one], [s for _, s in seven], rtol=1e-6)


def test_hmm_probabilities_sum_to_one(spark):
    """Over all texts of up to two words of a small vocabulary, the unknown word as one more, no more than one."""
    rows = [(1, "a b a b"), (2, "b a a"), (3, "c"), (4, "a c b")]
    ask = [*"abc", "zz"]
    texts = [""] + ask + [f"{x} {y}" for x in ask for y in ask] + [f"{x} {y} {z}" for x in ask for y in ask for z in ask]
    every = rows + [(100 + i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(every, "doc_id long, text string")
    got = {r.doc_id: r.score for r in hmm.score(df, F.col("doc_id") < 100).collect()}
    total = sum(10 ** got[100 + i] for i in range(len(texts)))
    assert 0.3 < total <= 1.0


def test_forward_parts_are_exact(monkeypatch):
    rnd = np.random.default_rng(1)
    p = hmm.Parameters(*(x / x.sum(axis=-1, keepdims=True) for x in (rnd.random(hmm.STATES), rnd.random((hmm.STATES, hmm.STATES)))),
                       (lambda e: e / e.sum(axis=0))(rnd.random((hmm.CLASSES, hmm.STATES))), np.full(hmm.STATES, 1 / hmm.STATES))
    size = [1, 7, 8, 9, 64, 65, 200]
    begin = np.cumsum([0, *size])
    obs = rnd.integers(0, hmm.CLASSES + 1, begin[-1]).astype(np.int32)
    monkeypatch.setattr(hmm, "PART", 8)
    got = hmm.Model(p, np.ones(hmm.CLASSES), 5, 1, 10).forward(obs, begin)
    emit = np.vstack([p.emit, np.ones(hmm.STATES)])
    for i, n in enumerate(size):
        alpha, log = p.start, 0.0
        for t in range(n):
            alpha = (alpha @ p.move if t else alpha) * emit[obs[begin[i] + t]]
            log += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        assert math.isclose(got[i], log, rel_tol=1e-9)


def test_baum_welch_raises_the_likelihood():
    rnd = np.random.default_rng(3)
    obs = np.concatenate([rnd.integers(0, 50, 400), rnd.integers(50, 100, 400)] * 10).astype(np.int32)
    begin = np.arange(0, len(obs), 400)
    emit = rnd.gamma(2.0, size=(hmm.CLASSES, hmm.STATES))
    move = np.full((hmm.STATES, hmm.STATES), 1 / hmm.STATES)
    p = hmm.Parameters(move[0], move, emit / emit.sum(axis=0), move[0])
    logs = []
    for _ in range(8):
        e = hmm.Expected()
        e.add(p, obs, begin, np.full(len(begin), 400), np.ones(len(begin), bool))
        assert math.isclose(e.emit.sum(), len(obs), rel_tol=1e-4)
        logs.append(e.log)
        p = e.parameters()
    assert logs[-1] > logs[1] > logs[0]


def test_langid_edges(docs, none):
    model = langid.train(docs)
    got = langid.identify(docs, model, keep=["doc_id", "k"])
    assert got.columns == ["doc_id", "k", "lang_pred", "score", "rejected"]
    rows = got.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    pred = {r.doc_id: r.lang_pred for r in rows}
    assert {i: pred[i] for i in (2, 3, 4, 19)} == dict.fromkeys((2, 3, 4, 19), "und") and pred[1] == "en" and pred[11] == "en"
    assert langid.identify(none, langid.train(none), keep=["doc_id"]).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, b"", keep=["doc_id"]).collect()} == {"und"}


def test_langid_does_not_depend_on_the_batch():
    m = langid.learn([prose(i, 100) for i in range(20)] + [prose(i, 100)[::-1] for i in range(20)], ["a"] * 20 + ["b"] * 20, 10**6)
    texts = ["the cat", "x", prose(50, 30), "", "9"]
    together = m.predict(texts)
    for i, t in enumerate(texts):
        alone = m.predict([t])
        assert alone[0][0] == together[0][i] and math.isclose(alone[1][0], together[1][i], rel_tol=1e-6)


def unlike(n):
    """Texts of random letters."""
    rnd = np.random.default_rng(5)
    return ["".join("abcdefghijklmnopqrstuvwxyz    "[i] for i in rnd.integers(30, size=k)) for k in (100, 300, 1000, 3000) for _ in range(n)]


def test_a_rare_label_does_not_switch_rejection_off():
    texts = [prose(i, 100) for i in range(40)] + [prose(i, 100)[::-1] for i in range(40)]
    for rare in ([], ["xq jw vk zzq", "qqq wx"], [prose(80, 100).upper().replace("E", "Ü")] * 6):
        m = langid.learn(texts + rare, ["a"] * 40 + ["b"] * 40 + ["c"] * len(rare), 10**6)
        assert m.predict(unlike(5))[2].all() and not m.predict([prose(i, 100) for i in range(60, 80)])[2].any()


def test_odd_calibration_documents_do_not_open_the_gate():
    """A language left out is rejected though some labels are wrong, and nothing of the learned languages is."""
    def of(seed, turn):
        return prose(seed, 200).translate(str.maketrans("abcdefghijklmnopqrstuvwxyz", turn))

    turns = {"a": "abcdefghijklmnopqrstuvwxyz", "b": "zyxwvutsrqponmlkjihgfedcba", "c": "nopqrstuvwxyzabcdefghijklm"}
    for out in turns:
        texts, langs = [], []
        for name in turns.keys() - {out}:
            for i in range(50):
                odd = i in (9, 24)  # calibrate: every fifth document does
                texts.append(unlike(1)[1 + i % 2] if odd else of(i, turns[name]))
                langs.append(name)
        m = langid.learn(texts, langs, 10**6)
        assert m.predict([of(i, turns[out]) for i in range(100, 120)])[2].all() and m.predict(unlike(5))[2].all()
        for name in turns.keys() - {out}:
            best, _, rejected = m.predict([of(i, turns[name]) for i in range(100, 120)])
            assert not rejected.any() and {m.langs[b] for b in best} == {name}


def plain_kneser_ney(texts, order=4):
    """p(symbol | the symbols before it) by dictionaries, of one language."""
    def clean(t):
        out = "".join(c.lower() if c.isalpha() else " " for c in t)
        return " " * (order - 1) + " ".join(out.split()) + (" " if out[-1:] == " " else "")

    counts = [None] * (order + 1)
    counts[order] = collections.Counter(c[i : i + order] for c in map(clean, texts) for i in range(len(c) - order + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])
    alphabet = len(counts[1]) + 1

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / alphabet
        once, twice = (sum(c == k for c in counts[n].values()) for k in (1, 2))
        d = min(0.95, max(0.05, once / (once + 2 * twice))) if once + twice else 0.5
        after = [c for g, c in counts[n].items() if g[:-1] == gram[:-1]]
        if not after:
            return p(gram[1:])
        return (max(counts[n][gram] - d, 0) + d * len(after) * p(gram[1:])) / sum(after)

    return p


def test_kneser_ney_equals_dictionaries():
    texts = [prose(i, 25) + ("!" if i % 2 else "") for i in range(6)]
    m, p = langid.learn(texts, ["a"] * 6, 10**6), plain_kneser_ney([t for i, t in enumerate(texts) if i % 5 != 4])
    for gram in ("the ", " the", "   a", "zzzz", "thez", "n th", "q wh", "whic", "ave ", "    ", "ßabc"):
        key = np.array([sum(ord(c) << (16 * (3 - j)) for j, c in enumerate(gram))], np.uint64)
        assert math.isclose(m.log_prob(key)[0, 0], math.log(p(gram)), rel_tol=1e-4, abs_tol=1e-5), gram


def test_langid_of_labels_without_letters_and_rare_scripts(spark):
    """A label that nothing can be learned from is left out; long documents are learned from their beginning; letters of all
    planes are letters."""
    assert langid.learn(["123", "", "4 5"], ["a"] * 3, 10**6) is None and langid.learn([], [], 10) is None
    m = langid.learn([prose(i, 100) for i in range(10)] + ["9 9"] + ["x" * 50] * 3, ["b"] * 10 + ["a"] + ["c"] * 3, 40)
    assert m.langs == ["b", "c"]
    rare = "".join(map(chr, range(0x30000, 0x30040)))
    assert m.predict([rare])[0][0] >= 0 and m.predict(["12 34"])[0][0] == -1
    long = langid.learn([prose(1, 5000)] * 3, ["b"] * 3, 1000)
    assert long.langs == ["b"] and not long.predict([prose(1, 80)])[2].any()
    rows = [(i, prose(i, 40), "en") for i in range(300)] + [(i, prose(i, 40)[::-1], "xx") for i in range(300, 310)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, seven = (langid.train(df.repartition(n), per_lang=64) for n in (1, 7))
    assert one == seven and langid.Models.load(one).langs == ["en", "xx"]


def test_kneser_ney_sums_to_one():
    m = langid.learn([prose(i, 300) for i in range(10)], ["a"] * 10, 10**6)
    letters = [k for k in range(32, 128)]
    for context in ("the", " an", "zzq", "   "):
        keys = np.array([sum(ord(x) << (16 * (3 - j)) for j, x in enumerate(context)) | c for c in letters], np.uint64)
        total = np.exp(m.log_prob(keys)[:, 0].astype(float)).sum()
        assert 0.9 < total < 1.6  # those beyond these letters, and the floor each unknown letter has


def test_classifiers_edges(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2, "x") for i in range(1, 20)] + [(None, 1, 1, "x"), (3, None, 5, "x")],
                                   "doc_id long, quality int, toxic int, k string")
    empty = labels.limit(0)
    for op, label in ((toxicity, "toxic"), (quality, "quality")):
        model = op.train(docs, labels, label)
        rows = op.score(docs, model, keep=["doc_id", "t"]).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
        same = [r.score for r in rows if r.doc_id == 7]
        assert len(same) == 2 and same[0] == same[1]
        assert op.score(none, model, keep=["doc_id"]).count() == 0
        assert {r.score for r in op.score(docs, op.train(docs, empty, label), keep=["doc_id"]).collect()} == {0.5}


def test_discriminant_equals_the_densities(spark):
    """Scores against Gaussian log densities by solving, not by factors; repeated label rows change nothing."""
    rnd = np.random.default_rng(4)
    rows = [(i, prose(i, 60) if i % 3 else " ".join("buy now !! 99 $$$".split() * int(rnd.integers(4, 30)))) for i in range(120)] + [(200, None), (201, prose(5, 20_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = [(i, int(i % 3 > 0)) for i in range(120)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = quality.train(docs, labels)
    x = quality.of_texts([t or "" for _, t in rows])
    fold = [brute.fold(i, 5) != 0 and i < 120 for i, _ in rows]
    seen = x[[j for j, ok in enumerate(fold) if ok]]
    y = np.array([int(i % 3 > 0) for (i, _), ok in zip(rows, fold, strict=True) if ok])
    z = (x - seen.mean(axis=0)) / (seen.std(axis=0) + 1e-6) * model.trust(x)
    own = z[fold]
    parts = [own[y == c] for c in (0, 1)]
    together = sum((p - p.mean(axis=0)).T @ (p - p.mean(axis=0)) for p in parts) / len(own)
    logs = []
    for p in parts:
        cov = 0.5 * np.cov(p.T, bias=True) + 0.5 * together
        cov = 0.9 * cov + 0.1 * np.diag(np.diag(cov)) + 1e-3 * np.eye(len(cov))
        d = z - p.mean(axis=0)
        logs.append(-0.5 * (np.einsum("ij,ij->i", d, np.linalg.solve(cov, d.T).T) + np.linalg.slogdet(cov)[1]))
    want = 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + math.log(y.sum() / (1 - y).sum()), -60, 60)))
    got = {r.doc_id: r.score for r in quality.score(docs, model, keep=["doc_id"]).collect()}
    assert np.allclose([got[i] for i, _ in rows], want, atol=1e-6)
    again = quality.train(docs, spark.createDataFrame(marks + [m for m in marks if m[1]] * 3, "doc_id long, quality int"))
    assert again.prior == model.prior


def test_toxicity_scores_equal_sums_over_distinct_grams(spark):
    rows = [(i, prose(i, 30) + (" you vile fool" if i % 4 == 0 else "")) for i in range(60)] + [(90, None), (91, "É "), (92, prose(1, 9000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    weight, bias = toxicity.train(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)], "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, (weight, bias), keep=["doc_id"]).collect()}
    for i, t in rows:
        raw = b" " + (t or "").translate(brute.LOWER).encode() + b" "
        grams = {raw[j : j + n] for n in toxicity.ORDERS for j in range(len(raw) - n + 1)}
        at = {(int.from_bytes(g, "big") + (len(g) << 56)) * 0x9E3779B97F4A7C15 % 2**64 >> (64 - toxicity.BITS) for g in grams}
        assert math.isclose(got[i], 1 / (1 + math.exp(-sum(float(weight[p]) for p in at) - bias)), rel_tol=1e-6)


def test_toxicity_learns_markers():
    texts = [prose(i, 150) + (" you utter blockhead " if i % 4 == 0 else " ") + prose(i + 1000, 50) for i in range(300)]
    labels = [int(i % 4 == 0) for i in range(300)]
    weight, bias = toxicity.fit(texts[:200], labels[:200])
    distinct = toxicity.Distinct()
    z = [weight[distinct(toxicity.places(np.frombuffer(t.encode(), np.uint8)))].sum() + bias for t in texts[200:]]
    assert [int(x >= 0) for x in z] == labels[200:]


def test_toxicity_has_the_prior_of_all_labels(spark):
    """A bounded sample moves neither the mean score nor the share of predicted texts away from those of the labels."""
    rows = [(i, prose(i, 40) + (" you utter blockhead " if i % 8 == 0 and i % 3 else " ")) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i, _ in rows], "doc_id long, toxic int")
    whole = toxicity.train(df, labels, per_class=2000)
    part = toxicity.train(df, labels, per_class=100)
    mean = [np.mean([r.score for r in toxicity.score(df, m, keep=["doc_id"]).collect()]) for m in (whole, part)]
    assert abs(mean[0] - 0.125) < 0.03 and abs(mean[1] - 0.125) < 0.03


def test_decontamination_against_brute_force(spark, docs, none):
    items = [(1, " ".join(PASSAGE.split()[5:40])), (2, " ".join(PASSAGE.split()[5:40])), (3, None), (4, "!!"), (5, "One"), (6, "one ONE"),
             (7, " ".join(LONG.split()[500:507])), (8, " ".join(LONG.split()[1000:1010])), (9, prose(500, 30)), (10, "ab " * 15)]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, k string")
    cols = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = ordered([(i, *w) for (i, _), w in zip(ROWS, brute.contamination(ROWS, items), strict=True)])
    assert by_row(decontaminate.judge(docs, bench), *cols) == want
    assert by_row(decontaminate.judge(docs, bench, broadcast_rows=1), *cols) == want
    assert decontaminate.judge(none, bench).count() == 0
    assert decontaminate.judge(docs, bench.limit(0)).where("contaminated").count() == 0
    left = decontaminate.without_hits(docs, bench)
    assert left.columns == docs.columns and left.count() == sum(not w[-1] for w in want)


def test_bpe_round_trip(docs, none):
    spec = bpe.read_spec(None)
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = by_row(bpe.digests(docs, spec, keep=["doc_id"], with_ids=True), "n_tokens", "ids_sha256", "decoded_sha256")
    want = []
    for i, t in ROWS:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(lib.decode(ids, skip_special_tokens=False))))
    assert got == ordered(want)
    back = bpe.decode(bpe.encode(docs, spec), spec)
    assert by_row(back, "text") == ordered([(i, t or "") for i, t in ROWS])
    assert bpe.digests(none, spec, keep=["doc_id"]).count() == 0


def test_bpe_words_against_library():
    codec = bpe.Codec(bpe.read_spec(None))
    enc, lib = bpe.Encoder(codec), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = np.random.default_rng(5)
    texts = ["".join(map(chr, rnd.choice([*range(32, 127), *range(160, 600), 0x3042, 0x1F600, 10], 80))) for _ in range(200)]
    texts += ["x" * 257, "ab" * 400, "don't we'll", " ", "\n\n  a", "\u0085 z", "a͸b"]
    for t in texts:
        words = enc.words(t)
        known = enc.ids(set(words))
        ids = [i for w in words for i in known[w]]
        assert ids == lib.encode(t, add_special_tokens=False).ids and codec.decode(ids) == t


def test_url_rules_and_edges(spark):
    rules = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
    rows = [(1, "http://a.example.org/es/1"), (2, "HTTP://EXAMPLE.ORG/en/12?x#y"), (3, "https://x.com/fr/"), (4, "https://x.com/de/1"), (5, None),
            (6, "no scheme"), (7, "http://notorg/"), (8, "http://x.org"), (9, "http://x.org?/es/"), (10, "http://É.ORG/en/1"), (11, "://"), (1, "http://b.net/fr/9")]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in rows], "page_id long, url string, host string, u_url string")
    got = {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in urls.Filter(rules, per_class=50).fit(df).judge(df).collect()}
    assert len(got) == len(rows) and {v for _, v in got.values()} <= {"allow", "block"}
    assert got[1, "a.example.org", "/es/1"] == ("example.org/es/", "block") and got[2, "example.org", "/en/12"] == ("example.org/en/1", "block")
    assert got[3, "x.com", "/fr/"] == ("com/fr/", "allow") and got[4, "x.com", "/de/1"] == ("com/de/", "block")
    assert got[5, "", ""][0] is None and got[6, "", ""][0] is None and got[7, "notorg", "/"][0] is None
    assert got[8, "x.org", ""][0] is None and got[9, "x.org", ""][0] is None and got[10, "É.org", "/en/1"] == ("org/", "allow")
    assert urls.Filter(rules).fit(df.limit(0)).judge(df.limit(0)).count() == 0
    assert {r.verdict for r in urls.Filter(()).fit(df).judge(df).collect()} == {"allow"}


def test_url_sample_keeps_the_shares_of_all_rows(spark):
    rules = (("allow", "site.com/x/"), ("block", "site.com/y/"))  # nothing else tells them apart
    rows = [f"http://a{i}.site.com/x/{i % 7}" for i in range(100, 500)] + [f"http://a{i}.site.com/y/{i % 7}" for i in range(100, 140)]
    df = spark.createDataFrame([(u,) for u in rows], "url string").withColumn("h", F.xxhash64("url"))
    hot = df.where("url like '%/y/%'").orderBy("h").first().url  # repeated, it would fill a sample of rows
    rows += [f"http://a{i}.site.com/z/{i % 7}" for i in range(100, 300)]
    for repeats in (0, 60):
        pages = spark.createDataFrame(list(enumerate(rows + [hot] * repeats)), "page_id long, url string")
        found = urls.Filter(rules, per_class=20).fit(pages)
        assert math.isclose(found.prior, math.log((40 + repeats) / 400))
        odds = {r.suffix: r.odds for r in found.by_last_two.collect()}
        assert math.isclose(odds["site.com"], found.prior, abs_tol=0.05)
        if not repeats:
            assert found.judge(pages).where("rule is null").agg(F.avg("block_score")).first()[0] < 0.3


def test_fingerprints_against_brute_force(docs, none):
    got = fingerprints.edited(docs)
    rows = ordered(ROWS)
    want = [(i, n, brute.sha(e)) for (i, _), (n, e) in zip(rows, brute.neighbour_edits([(i, t or "") for i, t in ordered([(i, t or "") for i, t in ROWS])]), strict=True)]
    assert by_row(got, "n_chars", "edited_sha256") == ordered(want)
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[2].fingerprint == by_id[3].fingerprint == by_id[4].fingerprint == fingerprints.EMPTY
    assert by_id[11].fingerprint == by_id[12].fingerprint and by_id[11].near_next == 1.0  # lower-cased alike
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in by_id.values())
    assert fingerprints.edited(none).count() == 0


def test_fingerprint_likeness_is_unbiased(spark):
    rows = [(i, prose(i, 120)) for i in range(150)]
    got = {r.doc_id: r.near_edited for r in fingerprints.edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = [len(a & b) / len(a | b) for (_, t), (_, e) in zip(rows, brute.neighbour_edits(rows), strict=True)
            for a, b in [(brute.shingles(t, 5), brute.shingles(e, 5))]]
    error = np.array([got[i] for i in range(150)]) - want
    assert abs(error.mean()) < 0.015 and np.sqrt((error**2).mean()) < 0.07


@pytest.mark.parametrize("size", [1, 4, 60])
def test_fingerprint_of_small_texts(spark, size):
    rows = [(0, prose(1, size)), (1, prose(1, size)), (2, prose(2, size)), (3, prose(3, size))]
    got = {r.doc_id: r for r in fingerprints.edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].near_next == 1.0 and got[1].near_next < 0.3 and got[2].near_next < 0.3


def near_rows():
    """A group whose members are near their origin but not always each other, exact copies, and unrelated texts."""
    rows = list(ROWS)
    base = prose(70, 60).split()
    for i in range(60):
        rnd = np.random.default_rng(200 + i)
        words = list(base)
        for j in rnd.choice(len(words), rnd.integers(1, 6), replace=False):
            words[j] = f"edit{i}x{j}"
        rows.append((100 + i, " ".join(words)))
    rows += [(300 + i, prose(70, 60)) for i in range(5)] + [(400 + i, prose(800 + i, 50)) for i in range(40)]
    return rows


@pytest.mark.parametrize("words", [2, 5])
@pytest.mark.parametrize("small", [False, True])
def test_near_duplicates_against_brute_force(spark, monkeypatch, words, small):
    rows = near_rows()
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, s string, root string").repartition(4)
    if small:  # hot keys and clusters of many blocks
        for name, value in (("HOT", 8), ("SHARD_ROWS", 3000), ("SHARED", 3)):
            monkeypatch.setattr(neardup, name, value)
    got = neardup.classes(df, words=words, block=7 if small else neardup.BLOCK)
    want = ordered([(i, *w) for (i, _), w in zip(rows, brute.near_classes(rows, words), strict=True)])
    assert by_row(got, "n_shingles", "component_id") == want


def template_texts(n, same=110, own=40, vocabulary=60, seed=12):
    """Texts of one template: `same` words in common, and `own` of each from a small vocabulary; some are near copies."""
    rnd = np.random.default_rng(seed)
    shared, words = prose(77, same), prose(78, vocabulary).split()
    out = []
    for i in range(n):
        if i % 9 == 8:
            w = out[-int(rnd.integers(1, 5))][1].split()
            w[int(rnd.integers(same, len(w)))] = "changed"
            out.append((i, " ".join(w)))
        else:
            out.append((i, shared + " " + " ".join(rnd.choice(words, own))))
    return out


@pytest.mark.parametrize("hot", [3, 40, neardup.HOT_SHINGLE])
def test_templates_link_exactly_across_blocks(spark, monkeypatch, hot):
    """One candidate cluster of many blocks with hardly any link in it; with shingles that are hot and without."""
    monkeypatch.setattr(neardup, "HOT_SHINGLE", hot)
    monkeypatch.setattr(neardup, "SHARED", 2)
    sizes = []
    plain = neardup._links
    monkeypatch.setattr(neardup, "_links", lambda rows, percent: (sizes.append(rows.groupBy("part").count().agg(F.max("count")).first()[0]), plain(rows, percent))[1])
    rows = template_texts(400)
    got = neardup.classes(spark.createDataFrame(rows, "doc_id long, text string"), words=2, block=40)
    want = [(i, *w) for (i, _), w in zip(rows, brute.near_classes(rows, 2), strict=True)]
    assert by_row(got, "n_shingles", "component_id") == want
    assert 1 < len({c for *_, c in want}) < 400 and all(x is None or x < 120 for x in sizes)


def test_prefixes_of_like_sets_meet():
    rnd = np.random.default_rng(8)
    counters = rnd.integers(0, 50, neardup.COUNTERS)
    for _ in range(400):
        n = int(rnd.integers(1, 60))
        a = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([rnd.permutation(a)[: rnd.integers(0, len(a) + 1)], rnd.integers(0, 2**63, rnd.integers(0, n // 4 + 2), dtype=np.uint64)]))
        same = len(np.intersect1d(a, b))
        if 100 * same >= 80 * (len(a) + len(b) - same):
            c = len(np.intersect1d(neardup.prefix(a, counters, 80), neardup.prefix(b, counters, 80)))
            assert c and 180 * (c + -(-80 * max(len(a), len(b)) // 100) - 1) >= 80 * (len(a) + len(b))


def test_one_of_each(spark, docs, none):
    kept = neardup.one_of_each(docs, words=5)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 2, 3, 4, 5, 6, 6, 7, 8, 9, 10, 11, 13, 15, 16, 17, 18, 19] and None in ids
    assert neardup.one_of_each(none, words=5).count() == 0 and neardup.classes(none, words=2).count() == 0


def repeat_rows():
    a, b = prose(31, 150), prose(32, 150)
    rows = [*ROWS, (50, a), (51, a + " x"), (52, prose(40, 5) + a[30:600] + b), (53, b[:500] + prose(41, 9) + b[100:700]), (54, "é" * 300 + a[:450]),
            (55, b[:399]), (56, b[:400]), (57, a[7:406]), (58, prose(60, 400) * 2)]
    return rows + [(600 + i, prose(900 + i, 30) + PASSAGE + prose(950 + i, 30)) for i in range(25)]


@pytest.mark.parametrize("small", [False, True])
def test_repeats_against_brute_force(spark, monkeypatch, small):
    rows = [(i, t if t is not LONG else LONG[:9000]) for i, t in repeat_rows()]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, k string, runs string").repartition(4)
    if small:  # anchors dealt to several shards, and texts of several stretches
        monkeypatch.setattr(suffixes, "CHUNK", 3)
        monkeypatch.setattr(suffixes, "SHARD_BYTES", 4000)
        monkeypatch.setattr(suffixes, "PLACE", 12)
        monkeypatch.setattr(suffixes, "PIECE", 3000)
    got = suffixes.dedup(df, keep=["doc_id", "k"], passages=51).select("doc_id", "n_bytes", F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)").alias("n_removed"),
                                                          F.size("spans").alias("n_spans"), "kept_sha256", "kept", "n_passage_words")
    want = ordered([(i, *w, n) for (i, _), w, (n, _) in zip(rows, brute.repeats(rows), brute.passages(rows), strict=True)])
    assert [(*x[:5], bytes(x[5]), x[6]) for x in by_row(got, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "n_passage_words")] == want


def passage_rows():
    """Runs of 50 to 70 words that other texts have too, with other white space, short words, copies, and one in many texts."""
    short = " ".join(f"{c}{d}" for c in "abcdef" for d in "0123456789")
    rows = [(i, t) for i, t in ROWS if t is not LONG]
    for n in (50, 51, 52, 70):
        own = prose(2000 + n, n)
        rows += [(2000 + 10 * n + j, f"{prose(3000 + 10 * n + j, 20)} {own.replace(' ', sep)} {prose(4000 + 10 * n + j, 20)}") for j, sep in enumerate((" ", "\n ", "\t"))]
    rows += [(5000, short), (5001, "x " + short + " y"), (5002, "é " + short[3:]), (5003, prose(1, 70) + " " + prose(1, 70)), (5004, LONG[:40_000]), (5005, LONG[300:30_000])]
    return rows + [(6000 + i, prose(6000 + i, 15) + "\n" + PASSAGE + " " + prose(7000 + i, 15)) for i in range(30)]


@pytest.mark.parametrize("small", [False, True])
def test_passages_against_brute_force(spark, monkeypatch, small):
    rows = passage_rows()
    if small:
        for name, value in (("CHUNK", 3), ("SHARD_BYTES", 4000), ("PIECE", 2000)):
            monkeypatch.setattr(suffixes, name, value)
    df = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], "doc_id long, text string, k string, runs string, n_chars long").repartition(4)
    got = suffixes.without_passages(df, n_chars="n_chars")
    assert got.columns == df.columns
    want = [(i, t, "x", "y", len(t)) for (i, _), (_, t) in zip(rows, brute.passages(rows), strict=True)]
    assert ordered(tuple(r) for r in got.collect()) == ordered(want)


def test_repeats_empty(none):
    assert suffixes.dedup(none, keep=["doc_id"], passages=51).count() == 0
    assert suffixes.without_passages(none).count() == 0


def test_suffix_array_and_common_prefixes():
    rnd = np.random.default_rng(2)
    texts = [bytes(rnd.integers(97, 99, rnd.integers(1, 90)).astype(np.uint8)) for _ in range(30)] + [b"", b"abab" * 20]
    size = np.array([len(t) for t in texts])
    begin = np.cumsum(size + 1) - size - 1
    sym = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.int32)
    ends = begin + size
    sym[ends] = 256 + np.arange(len(texts))
    plain = np.minimum(sym, 256)
    order, ranks = suffixes.suffix_array(plain, ends)
    suffix = [tuple(sym[i:].tolist()) for i in range(len(sym))]
    few, few_ranks = suffixes.suffix_array(np.where(plain == 256, 2, plain - 97), ends, 2)  # the same in a small alphabet
    assert few.tolist() == order.tolist() and sorted(few_ranks) == [31, 248]
    assert order.tolist() == sorted(range(len(sym)), key=lambda i: suffix[i])
    common = suffixes.common_prefixes(sym, begin, order, ranks)
    for a, b in zip(order[:-1], order[1:], strict=True):
        n = next(j for j, (x, y) in enumerate(zip(suffix[a], suffix[b], strict=False)) if x != y)
        assert common[b] == n


@pytest.mark.parametrize("part", [1_000_000, 40])
def test_components(spark, part):
    from carelens.llm.components import components
    rnd = np.random.default_rng(11)
    edges = [(int(a), int(b)) for a, b in rnd.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    got = components(spark.createDataFrame(edges, "a long, b long"), part=part).collect()
    assert len(got) == len(want) and {r["node"]: r["root"] for r in got} == want
