"""Vector codes, likelihood ratios and spelling variants against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gableframe.llm import likelihood, spelling, vector_codes

# --- vector codes -----------------------------------------------------------


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """``(vec_id, code, error, label)`` by full search, in Python's whole numbers."""
    kept = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out = []
    for dim in sorted({len(v) for _, v, _ in kept}):
        same = [(i, [max(-(b := vector_codes.limit(dim)), min(b, math.floor(256 * x))) for x in v], g) for i, v, g in kept if len(v) == dim]
        cut = vector_codes.edges(dim, parts)
        books = [[v[a:b] for _, v, _ in same[:entries]] for a, b in zip(cut, cut[1:])]
        for turn in range(rounds + 1):
            found = []
            for _, v, _ in same:
                code, error = [], 0
                for p, (a, b) in enumerate(zip(cut, cut[1:])):
                    square = [sum((x - y) ** 2 for x, y in zip(v[a:b], e)) for e in books[p]]
                    code.append(square.index(min(square)))
                    error += min(square)
                found.append((code, error))
            if turn == rounds:
                break
            for p, (a, b) in enumerate(zip(cut, cut[1:])):
                for e in range(len(books[p])):
                    mine = [v[a:b] for (_, v, _), (code, _) in zip(same, found) if code[p] == e]
                    if mine:
                        books[p][e] = [sum(column) // len(mine) for column in zip(*mine)]
        out += [(i, bytes(code).hex(), error, g) for (i, _, g), (code, error) in zip(same, found)]
    sums = Counter()
    for _, _, error, g in out:
        sums[g] += error
    return sorted(((i, code, error, min(sums[g], (1 << 63) - 1)) for i, code, error, g in out), key=repr)


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(32)] for _ in range(9)]
    rows = []
    for i in range(300):
        centre = rng.choice(centres)
        rows.append((i, [round(c + rng.gauss(0, 0.2), 2) for c in centre], rng.choice([1, 2, None])))
    rows += [(300 + i, list(rows[i][1]), 1) for i in range(40)]  # copies
    rows += [(5, list(rows[5][1]), 2), (5, [0.25] * 32, 2), (None, [0.5] * 32, 1)]
    rows += [(400, None, 1), (401, [1.0, None] * 16, 1), (402, [float("nan")] * 32, 1), (403, [float("inf")] + [0.0] * 31, 1)]
    rows += [(410 + i, [float(i), 1.0, -2.0 * i], 3) for i in range(5)] + [(420, [], 3), (421, [1e30] * 32, 4), (422, [-1e30] * 32, 4)]
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string, dim string"


@pytest.mark.parametrize("bounds, least", [(8, 2), (1, 1), (63, 63)])
def test_codes(spark, vectors, bounds, least):
    """Equal to full search whatever the number of bounds; clashing columns are not read."""
    table = spark.createDataFrame([(*r, "x", "x", "x") for r in vectors], SCHEMA).repartition(3)
    found = vector_codes.report(table, cfg=vector_codes.Settings(bounds=bounds, least=least)).collect()
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in found), key=repr) == plain_codes(vectors)
    assert len({r.codebooks_sha256 for r in found}) == 3  # three lengths of vectors


def test_codes_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vector_codes.report(empty).count() == 0
    none_kept = spark.createDataFrame([(1, None, 1, "", "", "")], SCHEMA)
    assert vector_codes.report(none_kept).count() == 0


def test_bounds_are_used():
    """After a small move most parts need few bounds, fewer are kept, and all stay below the distances."""
    rng = np.random.default_rng(0)
    rows = rng.integers(-300, 300, (500, 16))
    cfg = vector_codes.Settings(parts=4)
    book = vector_codes.Codebook(rows[:64].copy(), np.zeros((4, 64)))
    state, _ = vector_codes.first_search(rows, book, cfg)
    new = book.entries + rng.integers(-3, 4, book.entries.shape)
    moved = vector_codes.Codebook(new, vector_codes._moves(book.entries, new, 4))
    later, error = vector_codes.next_search(rows, state, moved, cfg)
    full, want = vector_codes.first_search(rows, moved, cfg)
    assert np.array_equal(later.code, full.code) and np.array_equal(error, want)
    assert 2 <= later.near.shape[2] < 8 and (later.used <= 2).mean() > 0.9
    assert (np.diff(later.low.astype(float), axis=2) >= 0).all()
    for p in range(4):
        far = np.sqrt(vector_codes._scan(rows[:, 4 * p : 4 * p + 4], new[:, 4 * p : 4 * p + 4]))
        assert (later.low[:, p].astype(float) <= np.take_along_axis(far, later.near[:, p].astype(int), axis=1)).all()
        rest = far.copy()
        np.put_along_axis(rest, np.c_[later.code[:, p], later.near[:, p]].astype(int), np.inf, axis=1)
        assert (later.outer[:, p].astype(float) <= rest.min(axis=1)).all()


# --- likelihood ratio -------------------------------------------------------


def plain_surface(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_surface_and_grams(monkeypatch):
    rng = random.Random(2)
    texts = [None, "", " \t\n", "a b a b a b a b", "x\n\n x\nx\n x", "a\x1cb\x85c a", "é|é <b> é|é", "one two three four five " * 3]
    texts += ["".join(rng.choice("ab| \n\t") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "!!", "12,5"]) for _ in range(3000))
    for text in [*texts, long]:
        assert likelihood.surface(text) == plain_surface(text)
    whole = [np.sort(np.concatenate(list(likelihood.grams(t, 1 << 14)))) for t in [*texts, long]]
    monkeypatch.setattr(likelihood, "_PIECE", 50)  # in pieces: the same words and pairs
    monkeypatch.setattr(likelihood.Hashes, "held", 3)
    for text, want in zip([*texts, long], whole):
        assert np.array_equal(np.sort(np.concatenate(list(likelihood.grams(text, 1 << 14)))), want)


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["an", "er", "th", "on", "es"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(300):
        words = [word() for _ in range(rng.randint(12, 80))]
        bad = i % 5 == 0
        rows.append((i, " ".join(w + rng.choice(["$$$", "%%%", "|"]) for w in words) if bad else " ".join(words) + ".", not bad))
    rows += [(300, None, False), (301, "", False), (302, "short text", False), (303, "same words again and so " * 20, False), (0, rows[1][1], True), (None, rows[2][1], True)]
    docs = spark.createDataFrame([(i, t, "x", "y", 7) for i, t, _ in rows], "doc_id long, text string, kept string, __text string, n_words int")
    labels = [(i, int(good), 0) for i, _, good in rows[:300] if i % 3 == 0] + [(1, 1, 1), (None, 1, 0), (4, 1, 0), (4, 0, 0)]
    return rows, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_likelihood(judged):
    rows, docs, labels, plain_labels = judged
    weights = likelihood.fit(docs, labels)
    good = {i for i, *_ in plain_labels if i is not None and all(q == 1 and t == 0 for j, q, t in plain_labels if j == i)}
    assert 1 not in good and 4 not in good
    raw, target = Counter(), Counter()
    found = {}
    for k, (i, text, _) in enumerate(rows):
        found[k] = [int(b) for part in likelihood.grams(text, 1 << 14) for b in part]
        raw.update(found[k])
        if i in good:
            target.update(found[k])
    sums = raw.total(), target.total()
    for b in raw:
        assert abs(weights[b] - 1e6 * math.log((target[b] + 4) / (raw[b] * (sums[1] / sums[0]) + 4))) <= 0.5001
    out = likelihood.judge(docs, weights, keep=("doc_id", "kept")).collect()
    assert len(out) == len(rows)
    by = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_grams, r.ratio_micro, r.kept) for r in out), key=repr)
    want = []
    for k, (i, text, good_one) in enumerate(rows):
        ratio = int(weights[found[k]].sum()) if found[k] else 0
        want.append((i, *plain_surface(text), len(found[k]), ratio, good_one))
        assert good_one == (ratio >= -300_000 * len(found[k]) and plain_surface(text)[0] >= 10 and 5 * plain_surface(text)[4] <= plain_surface(text)[0])
    assert by == sorted(want, key=repr)


def test_keep_good(spark, judged):
    rows, docs, labels, _ = judged
    kept = likelihood.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.kept, r.n_words) for r in kept.collect() if r.doc_id is not None) == sorted((i, t, "x", 7) for i, t, good in rows if good and i is not None)
    assert likelihood.keep_good(docs.limit(0), labels).count() == 0
    no_labels = likelihood.fit(docs, labels.limit(0))
    assert not no_labels.any()
    assert {r.doc_id for r in likelihood.judge(docs, no_labels).where("NOT kept").collect()} == {300, 301, 302, 303}


# --- spelling variants ------------------------------------------------------


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    close = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(close[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, words[w], len(close[w]), form[w], words.get(form[w]), root))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def typed():
    rng = random.Random(6)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 9))) for _ in range(60)] + ["Ünder", "zebra", "zebrà", "a" * 300, "a" * 299, "a" * 301]
    rows = []
    for i in range(400):
        words = []
        for _ in range(rng.randint(1, 60)):
            w = rng.choice(stems[: rng.randint(1, len(stems))])
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", "b"]) + w[at + rng.randint(0, 1) :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", ", ", "1"]).join(words)))
    rows += [(1, None), (2, ""), (3, "12 34"), (5, rows[5][1]), (None, rows[6][1]), (7, " ".join(stems * 40))]
    return rows


@pytest.mark.parametrize("leaf", [4096, 4])
def test_variants(spark, typed, leaf, monkeypatch):
    """Chains, ties, hot halves handed on until one place is left, and very long words."""
    monkeypatch.setattr(spelling, "_HELD", 50)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in typed], "doc_id long, text string, word string, n int").repartition(3)
    got = spelling.variants(docs, leaf=leaf).collect()
    want = plain_variants(typed)
    assert sorted(((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got), key=repr) == want
    assert any(row[3] is not None and row[5] != row[3] for row in want)  # a chain of two forms


def test_variants_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(docs).count() == 0


def test_short_words(spark):
    words = ["a", "b", "ab", "ba", "abc", "é", "aé"]
    got = spelling.neighbours(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()
    assert sorted((r.word, r.near) for r in got) == sorted((a, b) for a in words for b in words if near(a, b))


def test_search_hands_on_crowds():
    """A run that is too long is handed on whole, across batches; the others are searched."""
    rows = [(s, 6, 3, 0, w, 1) for s, n in ((1, 3), (2, 20), (3, 2)) for w in [f"abc{chr(97 + k)}{chr(97 + s)}z" for k in range(n)]]
    batches = [spelling._columns(rows[i : i + 7], [None] * len(rows[i : i + 7]), [None] * len(rows[i : i + 7])).select(range(6)) for i in range(0, len(rows), 7)]
    out = [r for b in spelling.search(iter(batches), 8) for r in b.to_pylist()]
    assert Counter(r["shard"] for r in out if r["near"] is None) == {2: 20}
    assert Counter(r["shard"] for r in out if r["near"] is not None) == {1: 6, 3: 2}
