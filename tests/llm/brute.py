"""Plain Python versions of what the operators compute."""

import collections
import hashlib
import math
import re
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def base_scores(rows, learn):
    """rows of (id, text): (n_tokens, n_known, N, base score) each."""
    tokens = [[*blank_words(t), ""] for _, t in rows]
    c = collections.Counter()
    for (i, _), w in zip(rows, tokens, strict=True):
        if learn(i):
            c.update(w)
    n, v = sum(c.values()), len(c)
    return [(len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)) for w in tokens]


def contamination(rows, items, window=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").translate(LOWER))
        size = min(window, len(w))
        for j in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[j : j + size])].add(i)
    out = []
    for _, t in rows:
        w = word.findall((t or "").translate(LOWER))
        hit, found = [0] * len(w), set()
        for size in {len(x) for x in windows}:
            for j in range(len(w) - size + 1):
                if tuple(w[j : j + size]) in windows:
                    found |= windows[tuple(w[j : j + size])]
                    hit[j : j + size] = [1] * size
        out.append((len(w), sum(hit), len(found), sha(",".join(sorted(map(str, found)))), any(hit)))
    return out


def neighbour_edits(rows):
    """rows sorted by (id, text), null ids first: (n_chars, edited text) each."""
    out = []
    for a, (_, t) in enumerate(rows):
        t, n = t or "", rows[(a + 1) % len(rows)][1] or ""
        out.append((len(t), t[: len(t) - len(t) // 4] + n[: len(t) // 4]))
    return out


def shingles(text, k):
    w = blank_words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near_classes(rows, k, percent=80):
    """(n_shingles, component id) of each row."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return [(len(s), least.get(find(a)) if s else i) for a, (s, (i, _)) in enumerate(zip(sets, rows, strict=True))]


def repeats(rows, length=400):
    """(n_bytes, n_removed, n_spans, kept_sha256, kept bytes) of each row."""
    raw = [(t or "").encode() for _, t in rows]
    starts = collections.Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if starts[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), sha(kept), kept))
    return out


def passages(rows, run=51):
    """(words in runs of `run` words that start anywhere else too, the text without them) of each row."""
    own = [[(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")] for _, t in rows]
    starts = collections.Counter(tuple(x for x, *_ in w[i : i + run]) for w in own for i in range(len(w) - run + 1))
    out = []
    for (_, t), w in zip(rows, own, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - run + 1):
            if starts[tuple(x for x, *_ in w[i : i + run])] > 1:
                gone[i : i + run] = [True] * run
        t, kept, at = t or "", "", 0
        for i, (_, a, _) in enumerate(w):
            if gone[i] and not (i and gone[i - 1]):
                kept += t[at:a]
            if gone[i]:
                at = w[i][2]
        out.append((sum(gone), kept + t[at:]))
    return out


def word_runs(doc_id, text):
    """(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of the damaged text."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            part = w[i : j + q]
            if len(part) >= max(12, 2 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                found.append((i, len(part), q))
            i = max(j, i + 1)
    found.sort()
    gone = {x for s, m, q in found for x in range(s + q, s + m)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    return (len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join("%d,%d,%d\n" % r for r in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def simhash(text):
    import xxhash

    w = blank_words(text)
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def hamming_classes(rows):
    """(fingerprint, component id) of each row."""
    fp = [simhash(t) for _, t in rows]
    left, least = set(range(len(rows))), {}
    while left:
        queue = [left.pop()]
        group = list(queue)
        while queue:
            a = queue.pop()
            hit = {b for b in left if (fp[a] ^ fp[b]).bit_count() <= 3}
            left -= hit
            queue += hit
            group += hit
        ids = [rows[a][0] for a in group if rows[a][0] is not None]
        least |= dict.fromkeys(group, min(ids, default=None))
    return [(f"{f:016x}", least[a]) for a, f in enumerate(fp)]


def damage(rows):
    """Conversation rows (conv_id, turn, role, text) after the planted damage."""
    out = []
    for c, t, role, text in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if h == 1 else re.sub(r"[.!?]", "", text) if h == 2 else text
        out += [(c, t, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    return out


def conversation_repairs(rows, plant=damage):
    """By conversation: (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), by search over all edits."""
    out = {c: (0, 0, 0, 0, 0, 0, "", sha("")) for c, *_ in rows}
    convs = collections.defaultdict(list)
    for c, t, role, text in plant(rows):
        convs[c].append((t, role, text))
    for c, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{r[1]}\0{r[2]}".encode()).digest()))
        fault, seen = [], set()
        for _, role, text in own:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, *_ in own if t is not None}
        first = [r[:1] for _, r, _ in own]
        best = {(0, ""): (0, "", ())}  # by rows done and initials' state: cost, audit, repaired rows
        after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
        for i in range(len(own) + 1):
            for _ in range(3):  # inserted rows
                for s in ("", "s", "u", "a"):
                    if (i, s) in best:
                        cost, audit, kept = best[i, s]
                        for role in ("user", "assistant"):
                            to = after.get((s, role[0]))
                            if to:
                                best[i, to] = min(best.get((i, to), (1e9, "")), (cost + 3, audit + "I", (*kept, (role, ""))))
            if i == len(own):
                break
            for s in ("", "s", "u", "a"):
                if (i, s) not in best:
                    continue
                cost, audit, kept = best[i, s]
                ways = [(s, 4, "D", ())]
                if fault[i] not in ("blank", "duplicate"):
                    more = 3 * (fault[i] == "truncated")
                    ways += [(after.get((s, r[0])), 3 + more, "R", ((r, own[i][2]),)) for r in ("user", "assistant")]
                    ways += [(after.get((s, first[i])), more, "K", (own[i][1:],))]
                for to, x, edit, row in ways:
                    if to is not None:
                        best[i + 1, to] = min(best.get((i + 1, to), (1e9, "")), (cost + x, audit + edit, kept + row))
        cost, audit, kept = min(best[len(own), s] for s in ("", "a") if (len(own), s) in best)
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(fault.count(x) for x in ("blank", "duplicate", "truncated")),
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False)), cost, audit, sha("\n".join(f"{r}:{t}" for r, t in kept)))
    return out
