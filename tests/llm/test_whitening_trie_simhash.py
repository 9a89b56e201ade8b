"""Whitening, prefix trie and SimHash against brute force, with the hard cases in the tables."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from starmart.llm import eigen, prefix_trie, simhash, whitening
from starmart.llm.parens import Parens
from starmart.scratch import Scratch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- whitening -------------------------------------------------------------------


@pytest.mark.parametrize("d", [1, 2, 3, 7, 40])
def test_eigenpairs_of_random_matrices(d):
    m = np.random.default_rng(d).normal(size=(d, 2 * d))
    a = m @ m.T
    values, axes = eigen.leading(a, 16)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:16], rtol=0, atol=1e-13 * values[0])
    assert np.abs(a @ axes - axes * values).max() < 1e-13 * values[0]
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13


@pytest.mark.parametrize("a", [np.eye(9), np.diag([3.0, 3, 3, 1, 1, 0, 0]), np.ones((6, 6)), np.zeros((4, 4)), np.kron(np.eye(5), np.ones((4, 4)))])
def test_eigenpairs_of_clusters(a):
    values, axes = eigen.leading(a, 16)
    assert np.abs(a @ axes - axes * values).max() < 1e-13 * max(values[0], 1)
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13


def test_deviations_are_exact_at_any_size():
    x = np.array([[10**5, 7], [-9, 6], [5, 6]])
    for n, base, rest in [(7, [0, 0], [0, 6]), (10**12 + 7, [5, 6], [3, 10**11]), (10**17, [-4, 2], [5, 1])]:
        expected = [sum((n * int(b) - (n * s + r)) ** 2 for b, s, r in zip(row, base, rest, strict=True)) for row in x]
        assert whitening.Mean(n, np.array(base), rest).deviations(x) == expected


def test_whitening(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(v) for v in rng.normal(size=6) * [3, 2, 1, 1, 0.5, 0.1]], 0, "x") for i in range(300)]
    good += [(5, good[5][1], 1, "again"), (None, good[7][1], 0, "no id")] + [(1000 + i, [9.0] * 6, 0, "copy") for i in range(200)]
    bad = [(1, None), (2, []), (3, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (4, [math.nan] * 6), (5, [math.inf] + [0.0] * 5), (6, [1e300] * 6), (7, [1.0, 2.0])]
    df = spark.createDataFrame(good + [(i, v, 0, "bad") for i, v in bad], "vec_id long, embedding array<float>, x int, n string").repartition(3)
    got = whitening.whiten(df, components=4).toPandas()
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(got) == 4 * len(good)
    x = np.floor(64 * np.array([np.float32(v) for _, v, _, _ in good], float)).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    assert set(got["n"]) == {n} and got["identity_error"].max() < 1e-9
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    trace = np.trace(np.cov(fit.T, bias=True))
    expected = defaultdict(list)
    for (i, *_), row in zip(good, x, strict=True):
        expected[i].append((int(((n * row - sums) ** 2).sum()), np.abs((row - sums / n) @ axes / np.sqrt(values))))
    for i, rows in got.groupby("vec_id", dropna=False):
        want = expected[None if math.isnan(i) else int(i)]
        assert len(rows) == 4 * len(want)
        assert {int(v) for v in rows["deviation"]} == {w[0] for w in want}
        for c, e in zip(range(4), values, strict=True):
            one = rows[rows["component"] == c + 1]
            assert np.allclose(np.abs(one["whitened"]), want[0][1][c], atol=1e-8)
            assert np.allclose(one["explained"], e / trace, rtol=1e-9)


def test_whitening_without_spread(spark):
    kind = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(5)], kind)
    assert {r["component"] for r in whitening.whiten(line).collect()} == {1}  # rank one: one component


# -- trie ------------------------------------------------------------------------


def test_parens_against_a_stack():
    rng = np.random.default_rng(3)
    for n in (1, 2, 60, 5000):
        bits, depth, left = [1], 1, n - 1
        while depth:
            if left and (depth == 1 or rng.random() < 0.5):
                bits, depth, left = bits + [1], depth + 1, left - 1
            else:
                bits, depth = bits + [0], depth - 1
        stack, close = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        opens = np.array(sorted(close))
        tree = Parens(np.array(bits, np.uint8))
        ends = tree.find_close(opens, chunk=37)
        assert ends.tolist() == [close[i] for i in opens.tolist()]
        text = "".join(map(str, bits))
        assert tree.leaves(opens, ends).tolist() == [text.count("10", i, close[i] + 1) for i in opens.tolist()]


def trie_by_hand(rows):
    own = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + v[h:])
    members, kids, below, out = defaultdict(list), defaultdict(list), {}, []
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        leaves = sum(below[k][0] for k in kids[p]) if kids[p] else 1
        saved = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(below[k][1] for k in kids[p])
        below[p] = (leaves, saved)
        ends = ",".join(map(str, sorted(c for c in members[p] if len(rebuilt[c]) == len(p))))
        up = min(members[p[:-1]]) if p else None
        out.append((min(members[p]), len(p), up, len(members[p]), len(kids[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations():
    rows = [(c, t, "user" if t % 2 else "assistant", f"é{t} {c % 3 if t > 2 else 0}") for c in range(60) for t in range(c % 7)]
    rows += [(c, t, "user", f"same {t}") for c in range(100, 260) for t in range(4)]  # one conversation, many times
    rows += [(300, t, "user", "again") for t in range(700)]  # a long one
    rows += [(None, 1, "user", "no id"), (400, None, None, None), (400, 0, "", None), (400, 1, "user", "a" * 100_000), (401, None, "", "")]
    rows += [(-7, 0, "user", "below zero"), (-7, 1, "user", "z"), (-5, 0, "user", "q")]
    # ends with the same letters, split between role and text in another way
    rows += [(500, 0, "ab", "c"), (505, 0, "a", "bc"), (510, 0, "ab", "c")]
    return [(*r, "x", 1) for r in rows]


@pytest.mark.parametrize("shard_turns", [1, 20, 1 << 18])
def test_trie(spark, shard_turns):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string, shard int").repartition(5)
    got = prefix_trie.trie(prefix_trie.rebuild(prefix_trie.turns(df)), shard_turns)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert rows_of(got) == trie_by_hand(rows)


def test_trie_of_nothing(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert prefix_trie.report(spark.createDataFrame([], kind)).count() == 0
    assert prefix_trie.report(spark.createDataFrame([(None, 1, "user", "x")], kind)).count() == 0


def test_trie_repeated_rows(spark):
    rows = [(1, 0, "user", "x"), (1, 0, "user", "x"), (5, 0, "user", "x"), (5, 0, "user", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefix_trie.report(df).collect()
    assert max(r["depth"] for r in got) == 2  # a repeated row is a turn of its own


# -- simhash ---------------------------------------------------------------------


def mark_by_hand(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    s = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def least_reachable(marks, ids, bits=3):
    part = list(range(len(marks)))

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    a = np.array(marks, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= bits) + i + 1:
            x, y = find(i), find(int(j))
            part[max(x, y)] = min(x, y)
    groups = defaultdict(list)
    for i, x in enumerate(ids):
        groups[find(i)].append(x)
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(ids))]


def test_planes_find_all_pairs():
    for a in range(8):
        for b in range(8):
            for c in range(8):
                assert any(not {a, b, c} & set(p) for p in simhash.PLANES)


def test_simhash(spark):
    prose = " ".join(f"w{i * i % 89} v{i % 31}" for i in range(200))
    texts = [prose, prose, prose + " end", prose.replace("w4 ", "W4\t"), None, "", " \n ", "one", "One", "one two", "a b c", "x " * 30_000, "é É ü " * 9]
    texts += [prose.replace(f"v{i} ", "u ") for i in range(30)] + [f"t{i} " * 5 for i in range(40)] + ["copy of many"] * 300
    ids = [*range(len(texts) - 2), 3, None]
    df = spark.createDataFrame([(i, t, 1, "f") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, n int, fingerprint string").repartition(4)
    got = simhash.near_duplicates(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    marks = [mark_by_hand(t) for t in texts]
    expected = zip(ids, [f"{m:016x}" for m in marks], least_reachable(marks, ids), strict=True)
    assert rows_of(got) == sorted(expected, key=repr)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_long_lists_lose_no_link(spark, monkeypatch):
    """Many fingerprints with equal bytes: lists are split by a fifth byte, then into blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(2)
    marks = {int(m) for m in rng.integers(0, 1 << 12, 300)} | {int(m) << 40 | 5 for m in rng.integers(0, 1 << 9, 200)}
    marks = sorted(marks | {int(m) for m in rng.integers(0, 1 << 62, 200)})
    ids = rng.permutation(len(marks)).tolist()
    classes = spark.createDataFrame(list(zip(marks, ids, strict=True)), "fingerprint long, id long")
    with Scratch(spark) as scratch:
        links = [tuple(r) for r in simhash.link(classes, scratch).collect()]
    where = {m: i for i, m in enumerate(marks)}
    assert all(ids[where[fa]] == ia and ids[where[fb]] == ib for fa, ia, fb, ib in links)
    part = {i: i for i in ids}

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    for _, a, _, b in links:
        x, y = find(a), find(b)
        part[max(x, y)] = min(x, y)
    assert [find(i) for i in ids] == least_reachable(marks, ids)
