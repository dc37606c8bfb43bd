"""PartEnum join against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_docs import odd_rows, text, words
from test_search_and_dedup import brute_components, shingles
from wideframe.llm import partenum as P


def check(few, rows, k, threshold, parts=3, **options):
    df = few.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("x"), "cls": F.lit(1), "component_id": F.lit(2)})
    got = P.similar_documents(df.repartition(parts), k=k, threshold=threshold, **options).collect()
    find = brute_components(rows, k, threshold)
    assert Counter((r.id, r.n_shingles) for r in got) == Counter((i, len(shingles(t, k))) for i, t in rows)
    full = {i for i, t in rows if shingles(t, k)}
    for r in got:
        assert r.component_id == (None if r.id is None else find(r.id) if r.id in full else r.id)


@pytest.mark.parametrize("k, threshold", [(3, 90), (5, 80)])
def test_join_on_odd_rows(few, k, threshold):
    check(few, [(i, t) for i, t, *_ in odd_rows()] + [(400, text(2, 119)), (401, "one two"), (402, "ONE two"), (10, text(2, 118))], k, threshold)


def changed(r, base, n):
    w = list(base)
    for _ in range(n):
        w[r.randrange(len(w))] = f"v{r.randrange(9999)}"
    return " ".join(w)


@pytest.mark.parametrize("options", [{}, {"rounds": 0, "small": 4, "block": 16}, {"rounds": 1, "small": 0, "block": 7}])
def test_join_of_crowds_around_the_threshold(few, options):
    r, base = random.Random(7), words(9, 200)
    rows = [(i, changed(r, base, i % 9)) for i in range(120)]  # similarity around 0.9 and below
    rows += [(1000 + i, " ".join(words(10, 60) + words(100 + i, 12))) for i in range(60)]
    rows += [(2000 + i, rows[3][1].upper()) for i in range(30)]
    rows += [(3000 + i, changed(r, words(40 + i % 8, 12 + i % 8), i % 2)) for i in range(60)]
    check(few, rows, 3, 90, **options)


def test_every_similar_pair_shares_a_signature():
    rng = np.random.default_rng(3)
    for threshold in (80, 90, 95):
        table = P.levels(threshold)
        assert table[0].low == 1 and all(a.high + 1 == b.low for a, b in zip(table, table[1:]))
        for n in (*range(1, 40), 77, 200, 1500):
            for _ in range(6):
                a = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
                gone, new = sorted(rng.integers(0, n + 1, 2))
                gone = min(int(gone), (100 - threshold) * n // 100 + 1)
                b = np.unique(np.r_[a[gone:], rng.integers(0, 2 ** 63, min(int(new), n // 5 + 1), dtype=np.uint64)])
                both = len(np.intersect1d(a, b))
                if both == len(a) == len(b) or 100 * both < threshold * (len(a) + len(b) - both):
                    continue
                x, y = P.signatures([a, b], threshold, table)
                assert len(np.intersect1d(x, y)), (threshold, n, len(a), len(b), both)
                u, v = (np.frombuffer(s, np.uint64) for s in P.parity([a, b]))
                assert P.near(len(a), len(b), P.apart(u, v), threshold)


def test_a_group_behind_one_signature_may_span_tasks(few):
    sigs = np.arange(3, dtype=np.int64)
    rows = [(i, (sigs if i % 2 else sigs[:1]).tobytes()) for i in range(500)] + [(900 + i, np.array([100 + i]).tobytes()) for i in range(50)]
    df = few.createDataFrame(rows, "cls long, sigs binary")
    got = P.shared(df.repartition(5)).collect()
    n = Counter(r.sig for r in got)
    assert (n[0], n[1], n[2]) == (500, 250, 250) and sum(n.values()) <= 1000 + 2 * 8
    assert P.shared(df.limit(0)).count() == 0
