"""Prefix trie, ranked search and vector search against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casaframe.llm import prefix_trie as T
from casaframe.llm import ranked_search as R
from casaframe.llm import vector_search as V

CONVERSATIONS = "conv_id long, turn long, role string, text string"


# ------------------------------------------------------------------ prefix trie

def trie_by_hand(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            named = f"{len(role.encode())}:{role}{text}".encode()
            own.setdefault(c, []).append(((turn is not None, turn or 0), role,
                                          hashlib.sha256(named).digest()[:16], text))
    own = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in own.items()}
    nodes = {}
    for c, seq in own.items():
        base, h = c - c % 5, zlib.crc32(str(c).encode()) % 9
        p = seq if base == c else own.get(base, [])[:h] + seq[h:]
        for d in range(len(p) + 1):
            node = nodes.setdefault(tuple(p[:d]), ([], []))
            node[0].append(c)
            if d == len(p):
                node[1].append(c)
    kids = Counter(p[:-1] for p in nodes if p)
    own_saving = {p: (len(m) - 1) * len(p[-1][1].encode()) if p else 0 for p, (m, _) in nodes.items()}
    leaves, saved = Counter(), Counter()
    for p in nodes:
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += own_saving[p]
    return sorted((min(m), len(p), min(nodes[p[:-1]][0]) if p else None, len(m), kids[p], leaves[p],
                   saved[p], hashlib.sha256(",".join(map(str, sorted(e))).encode()).hexdigest())
                  for p, (m, e) in nodes.items())


def trie(spark, rows, **kw):
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(3)
    return sorted(map(tuple, T.prefix_trie(df, **kw).collect()), key=lambda r: tuple(map(str, r))), df


def same(got, want):
    assert sorted(got, key=str) == sorted(want, key=str)


def talks(seed, n, turns=6, kinds=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        rows += [(c, k, rng.choice(["user", "bot"]), f"t{rng.randrange(kinds)}é") for k in
                 range(rng.randint(0, turns))]
    return rows


@pytest.mark.parametrize("shard_bytes", [T.SHARD_BYTES, 2000, 200])
def test_trie_matches_brute_force_on_one_and_many_levels(spark, shard_bytes):
    rows = talks(3, 200)
    got, _ = trie(spark, rows, shard_bytes=shard_bytes)
    same(got, trie_by_hand(rows))


def test_trie_spines_meet_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(T, "SPINES_PER_SHARD", 3)
    rows = talks(5, 300, turns=9, kinds=2)
    got, _ = trie(spark, rows, shard_bytes=150)
    same(got, trie_by_hand(rows))


def test_trie_odd_rows(spark):
    long_text = "x" * 1_000_000
    rows = [(0, None, "user", "first"), (0, 1, None, None), (0, 1, "a", "tie"), (0, 1, "a", "tie"),
            (7, 0, "user", "no base of its own"), (None, 0, "user", "lost"), (-3, 0, "user", "neg"),
            (-5, 0, "user", "base of neg"), (1, 0, "user", "hi"), (2, 5, "user", long_text),
            (2**63 - 1, 0, "u", "max"), (-2**63, 0, "u", "min")]
    got, _ = trie(spark, rows)
    same(got, trie_by_hand(rows))
    assert trie(spark, [])[0] == []


def test_trie_of_a_hot_conversation_and_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK_IDS", 7)
    rows = [(c, k, "user", f"same {k}") for c in range(0, 1500, 5) for k in range(3)]
    rows += [(100_000, k, "user", f"turn {k}") for k in range(90)]
    got, _ = trie(spark, rows, shard_bytes=3000)
    same(got, trie_by_hand(rows))


def test_trie_of_a_very_long_conversation(spark):
    n = 50_000
    got, _ = trie(spark, [(0, k, "user", f"turn {k}") for k in range(n)] + [(5, 0, "user", "turn 0")])
    assert len(got) == n + 1
    by_depth = {r[1]: r for r in got}
    assert by_depth[0][3:7] == (2, 1, 1, 6) and by_depth[1][3:7] == (2, 1, 1, 6)
    assert all(by_depth[d][3:7] == (1, int(d < n), 1, 0) for d in range(2, n + 1))


def test_trie_takes_extra_columns(spark):
    rows = [(0, 0, "user", "a"), (5, 0, "user", "a")]
    df = spark.createDataFrame([(*r, b"k", 1, 2) for r in rows],
                               CONVERSATIONS + ", key binary, depth int, family int")
    same(list(map(tuple, T.prefix_trie(df).collect())), trie_by_hand(rows))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=9), min_size=1, max_size=40), st.integers(1, 70))
def test_findclose_matches_a_stack(paths, block):
    bits, before = [1], []
    for p in sorted(set(map(tuple, paths))):
        k = 0
        while k < min(len(p), len(before)) and p[k] == before[k]:
            k += 1
        bits += [0] * (len(before) - k) + [1] * (len(p) - k)
        before = p
    bits += [0] * (len(before) + 1)
    want, stack = {}, []
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    bp = T.Parentheses(np.array(bits, dtype=np.int8), block)
    assert bp.findclose(bp.opens).tolist() == [want[i] for i in bp.opens.tolist()]


# ------------------------------------------------------------------ ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranked_by_hand(docs, items, top=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c in held:
            m = 10 + (90 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


WORDS = [f"{a}{b}" for a in ("al", "Be", "gå", "日", "x1") for b in ("", "ta", "TO", "9", "ün")]


def searched(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    return sorted(map(tuple, R.ranked_search(d, i, **kw).collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"shard_docs": 16}, {"block_terms": 40, "shard_docs": 50}, {"top": 3}])
def test_ranked_search_matches_brute_force(spark, kw):
    rng = random.Random(2)
    sep = [" ", ", ", "-", "\n", "_"]
    text = lambda n: "".join(rng.choice(WORDS) + rng.choice(sep) for _ in range(n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(150)]
    docs += [(900 + i, docs[3][1]) for i in range(30)] + [(901, docs[3][1]), (None, docs[3][1]),
             (1000, None), (1001, ""), (1002, "?! ..."), (1003, text(20_000)), (1004, "a" * 300_000)]
    items = [(i, text(rng.randint(1, 8))) for i in range(25)]
    items += [(50, None), (51, ""), (52, "unheard-of"), (3, "another al"), items[0]]
    want = ranked_by_hand(docs, [x for x in items if x[1] is not None], kw.get("top", 10))
    assert searched(spark, docs, items, **kw) == want


def test_ranked_search_of_empty_tables(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a b")], []) == []
    assert searched(spark, [(1, None)], [(1, "a")]) == []


def test_treap_waits_with_bounded_pool(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows, cols, value = rng.integers(0, 40, 3000), rng.integers(0, 500, 3000), rng.integers(1, 99, 3000)
    cell = np.unique(rows * 500 + cols, return_index=True)[1]
    rows, cols, value = rows[cell], cols[cell], value[cell]
    treap = R.Treap(rows, cols, value, 40, 500)
    asked, weight = np.arange(0, 40, 3), np.arange(14) + 1
    score = np.zeros(500, dtype=np.int64)
    for r, c, v in zip(rows, cols, value):
        if r % 3 == 0:
            score[c] += v * weight[r // 3]
    tenth = np.sort(score)[-10]
    for pool in (1 << 21, 64):
        monkeypatch.setattr(R, "POOL", pool)
        got = dict(zip(*(x.tolist() for x in treap.search(asked, weight, 0, 10, batch=8))))
        assert got == {c: s for c, s in enumerate(score.tolist()) if s >= max(1, tenth)}


def test_treap_search_leaves_most_documents_unopened():
    """One document holds an item's rare terms: the bounds keep the search near it."""
    rng = np.random.default_rng(4)
    common = [(t, d, int(rng.integers(1, 50))) for t in range(8) for d in range(4096)]
    rare = [(t, d, 900) for t in range(8, 32) for d in rng.choice(4096, 3, replace=False).tolist()]
    rare += [(t, 77, 999) for t in range(8, 32)]
    table = {(t, d): v for t, d, v in common + rare}
    row, col = (np.array(x) for x in zip(*table))
    treap = R.Treap(row, col, np.array(list(table.values())), 32, 4096)
    opened = []
    child = treap.child
    treap.child = lambda c, q: opened.append(len(c)) or child(c, q)
    treap.search(np.arange(32), np.where(np.arange(32) < 8, 1, 50), 0, 10, batch=16)
    assert sum(opened) < 4096


# ------------------------------------------------------------------ vector search

def near_by_hand(rows, every=10, top=10):
    fine = {(i, tuple(v)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)
            and any(v)}
    out = []
    for i, q in fine:
        if i is None or i % every:
            continue
        d = sorted((float(np.sqrt(((np.array(c) - np.array(q)) ** 2).sum())), j is None, j or 0, j)
                   for j, c in fine if len(c) == len(q) and (j, c) != (i, q))
        out += [(i, k + 1, j, s) for k, (s, _, _, j) in enumerate(d[:top])]
    return out


def vectors(seed, n, dim, groups=8):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(groups, dim))
    return [(i, [float(np.float32(x)) for x in mid[i % groups] + 0.2 * rng.normal(size=dim)])
            for i in range(n)]


def neighbours(spark, rows, schema="vec_id long, embedding array<double>", **kw):
    df = spark.createDataFrame(rows, schema).repartition(3)
    return list(map(tuple, V.nearest_neighbours(df, every=10, **kw).collect()))


def close_to(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=str), sorted(want, key=str)):
        assert g[:3] == w[:3] and abs(g[3] - w[3]) < 1e-12


@pytest.mark.parametrize("kw", [{}, {"shard": 100, "leaf": 8}, {"block_values": 64, "leaf": 4}])
def test_factor_one_is_exact(spark, kw):
    rows = vectors(1, 600, 8)
    rows += [(700 + i, rows[20][1]) for i in range(25)]          # ties go to the smaller id
    close_to(neighbours(spark, rows, **kw), near_by_hand(rows))


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, None]),
            (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (10, [1.0, 2.0, 3.0]),
            (20, [1.0, 1.0]), (20, [1.0, 1.0]), (20, [2.0, 1.0]), (None, [1.0, 0.5]), (None, None)]
    close_to(neighbours(spark, rows), near_by_hand(rows))
    assert neighbours(spark, []) == []


def test_relaxed_pruning_reads_less_and_keeps_recall():
    rows = vectors(3, 4000, 16, groups=20)
    x = np.array([v for _, v in rows])
    tree = V.Tree([i for i, _ in rows], x)
    _, ids, xs, vantage, radius, cuts, steps, way = tree.pack()
    num = lambda b, kind="<f8": np.frombuffer(b, dtype=kind)
    visited, recall = {}, {}
    want = {}
    for relax in (1.0, 1.5, 3.0):
        asked = [i for i in range(0, 4000, 100)]
        block = V.Block(asked, asked, x[asked], 10)
        block.search(num(xs).reshape(-1, 16), np.array(ids), np.zeros(4000, dtype=bool),
                     num(vantage).reshape(-1, 16), num(radius).reshape(-1, 2), num(cuts, "<i8"),
                     num(way, "<i4").reshape(len(cuts) // 8 - 1, steps, 2), relax)
        got = {}
        for q, _, i, _ in block.rows():
            got.setdefault(q, set()).add(i)
        want = want or got
        visited[relax] = block.visited
        recall[relax] = sum(len(got[q] & want[q]) for q in want) / sum(map(len, want.values()))
    assert visited[1.0] > visited[1.5] > visited[3.0] and visited[1.0] < 0.6 * 40 * 4000
    assert recall[1.0] == 1.0 and recall[1.5] >= 0.9
