"""Fill-in-middle frames and lexical search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_docs import odd_rows, text, words
from wideframe.llm import fim, lexical
from wideframe.llm.common import stored


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_fim(key, t):
    h = [int(hashlib.sha256(f"1:{key}".encode()).hexdigest()[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(t)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or re.search("<[PSM]>", t) or h[2] % 100 >= 90:
        return "plain", None, None, t
    p, m, s = t[:a], t[a:b], t[b:]
    if h[3] % 100 < 20:
        return "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


ODD = [(i, t) for i, t, *_ in odd_rows()] + [(200, "a <P> b"), (201, "x" * 50 + "<S>" + "y"), (202, "<M>"), (203, "<<S<P<M>")]
ODD += [(300 + i, "<S<P<M" * 9 + "\U0001f600é" * i) for i in range(60)]


@pytest.mark.parametrize("units", [1, 7, 16_384])
def test_fim_equals_plain_string_work(few, units):
    rows = ODD if units > 1 else [r for r in ODD if len(r[1] or "") < 2000]
    df = few.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("x"), "frames": F.lit(1), "id": F.lit(2)})
    store = stored(fim.framed(df, units=units), "frames")
    assert store.selectExpr("max(size(frames)) = max(CAST(ceil(n / %d) AS INT))" % units).first()[0]
    got = fim.digests(fim.transformed(store)).collect()
    want = []
    for i, t in rows:
        form, a, m, out = brute_fim("" if i is None else i, t or "")
        want.append((i, len(t or ""), form, a, m, sha(out), sha(t or "")))
    assert Counter(map(tuple, got)) == Counter(want)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.digests(fim.transformed(fim.framed(df.limit(0)))).count() == 0


def test_a_span_opens_only_the_frames_it_cuts(monkeypatch):
    t = "".join(chr(33 + i % 900) for i in range(1000))
    f = fim.Frames.of(t, 100)
    opened, first = [], fim.Frames.open
    monkeypatch.setattr(fim.Frames, "open", lambda self, i: opened.append(i) or first(self, i))
    part = fim.Frames()
    part.take(f, 150, 720)
    assert opened == [1, 7] and len(part) == 570 and part.blobs[1:-1] == f.blobs[2:7]
    assert part.text() == t[150:720] and f.text(990) == t[990:] and f.text(5, 5) == ""
    assert fim.Frames.of("").text() == "" and len(fim.Frames.of("")) == 0


def test_markers_are_found_across_frames():
    for units in range(1, 8):
        f = fim.Frames.of("ab<S<S>cd<M>", units)
        assert (f.find("<S>"), f.find("<S>", 5), f.find("<M>", 3), f.find("<P>")) == (4, -1, 9, -1)


def test_transformed_frames_are_text_that_others_can_read(few):
    df = few.createDataFrame([(i, text(i, 300)) for i in range(20)], "doc_id long, text string")
    for r in fim.transformed(fim.framed(df, units=64)).collect():
        assert fim.Frames(r.ends, r.frames).text() == brute_fim(r.id, text(r.id, 300))[3]


TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERMS.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))


def brute_search(docs, items, k):
    docs = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = {}
    for item, ts in asked.items():
        found = []
        for i, c in docs:
            m = 50 + (50 * sum(c.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in ts if c[t])
            if s > 0:
                found.append((-s, i is None, i if i is not None else 0))
        out[item] = [(r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return {i: v for i, v in out.items() if v}


def check_search(few, docs, items, k=50, **options):
    d = few.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("x"), "rank": F.lit(1), "term": F.lit(2)}).repartition(3)
    q = few.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = defaultdict(list)
    for r in lexical.search(d, q, k=k, **options).collect():
        got[r.item_id].append((r["rank"], r.doc_id, r.score))
    assert {i: sorted(v) for i, v in got.items()} == brute_search(docs, items, k)


ITEMS = [(1, "w1 W2 w3, w4"), (2, "café 中文 12"), (3, None), (4, ""), (5, "nothing-here"), (6, "w7 w7 w7"), (7, " ".join(f"w{i}" for i in range(150))),
         (8, "w9"), (8, "w10 w11"), (None, "w5 w6"), (9, "the same long line")]


def test_search_on_odd_rows(few):
    check_search(few, [(i, t) for i, t, *_ in odd_rows()], ITEMS)
    check_search(few, [(i, t) for i, t, *_ in odd_rows()], ITEMS, k=3, item_terms=20)
    d = few.createDataFrame([], "doc_id long, text string")
    q = few.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(d, q).count() == 0 and lexical.search(q.withColumnRenamed("item_id", "doc_id"), q.limit(0)).count() == 0


def test_search_with_ties_crowds_and_small_blocks(few):
    r = random.Random(4)
    docs = [(i, text(i, r.randrange(1, 120))) for i in range(600)]
    docs += [(1000 + i, "w1 w2 same words w3") for i in range(150)]  # one group of copies: ties by id
    docs += [(5000, " ".join(["w1"] * 3000 + words(3, 2000)))]
    items = [(i, " ".join(words(900 + i, 12))) for i in range(12)] + [(50, "w1 w2 w3"), (51, " ".join(f"w{i}" for i in range(100)))]
    for block in (32, 4096):
        check_search(few, docs, items, k=20, block_docs=block)


def test_groups_are_left_out_only_when_out_of_reach():
    # every document of a block that could enter is scored, whatever came before
    rng = np.random.default_rng(2)
    n = rng.integers(1, 400, 500)
    held = [(t, d, int(rng.integers(1, 9))) for t in range(8) for d in range(500) if rng.random() < 0.1 * (t + 1)]
    term, doc, tf = (np.array(x) for x in zip(*held))
    names, found = np.unique(term, return_counts=True)
    row = {"ids": np.arange(500).tobytes(), "known": np.ones(500, np.uint8).tobytes(), "n": n.astype(np.int64).tobytes(),
           "terms": names.astype("<i4").tobytes(), "counts": found.astype("<i4").tobytes(), "places": doc.astype("<u2").tobytes(), "tf": tf.astype("<u4").tobytes()}
    block, weight = lexical.Block(row, 500, int(n.sum())), np.arange(900, 100, -100)
    every = block.score(list(range(8)), weight, np.arange(500))
    for k in (1, 10, 50):
        best = lexical.Best(k)
        block.search(list(range(8)), weight, best)
        order = np.lexsort((np.arange(500), -every))[:k]
        assert best.id.tolist() == order.tolist() and best.score.tolist() == every[order].tolist()
