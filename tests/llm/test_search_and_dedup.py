"""Top-k, near-dedup, line dedup, url filter, language model and pipeline
against brute force, on odd rows and on crowded groups."""

import inspect
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_docs import DOCS, odd_rows, text, words
from wideframe.llm import forest, lm
from wideframe.llm.components import components
from wideframe.llm.linedup import dedup_lines, similar_lines
from wideframe.llm.lm import score_documents
from wideframe.llm.topk import BallTree, exact_scores, top_k
from wideframe.llm.urls import UrlRule, filter_urls


def brute_top(rows, k=10):
    ok = {i: [math.floor(1024 * x) for x in v] for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = {}
    for q in ok:
        if q % 100 == 0:
            s = sorted((-sum(a * b for a, b in zip(ok[q], v)), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))
            out[q] = [(r + 1, i, -x) for r, (x, i) in enumerate(s[:k])]
    return out


def test_top_k_is_exact(few):
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(500)]
    rows += [(1000 + i, [0.5] * 8) for i in range(120)]  # one very common vector
    rows += [(700, None), (701, [1.0, None] + [0.0] * 6), (800, [float("nan")] * 8), (801, [float("inf")] * 8),
             (900, [1.0, 2.0]), (901, [3.0, -1.0]), (None, [0.1] * 8), (902, [])]
    df = few.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit("x"), "score": F.lit(1)})
    got = defaultdict(list)
    for x in top_k(df, shard_rows=100, block=4).collect():
        got[x.query_id].append((x.rank, x.vec_id, x.score))
    assert {q: sorted(v) for q, v in got.items()} == {q: v for q, v in brute_top(rows).items() if v}
    assert top_k(df.limit(0)).count() == 0


def test_ball_tree_bounds_hold():
    rng = np.random.default_rng(1)
    v = np.floor(rng.normal(0, 300, (300, 6)))
    tree = BallTree(v, np.arange(300), leaf=16)
    q = np.floor(rng.normal(0, 300, (20, 6)))
    for node, m in tree.members.items():
        assert (tree.bounds(node, q, np.sqrt((q ** 2).sum(axis=1))) >= (q @ v[m].T).max(axis=1)).all()
    big = np.array([[2.0 ** 40, 3.0]])
    assert exact_scores(big, np.array([[2.0 ** 20, 1.0]])).tolist() == [[2 ** 60 + 3]]


def shingles(t, k):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, k, threshold=80):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    for n, (i, s) in enumerate(sets):
        find(i)
        for j, t in sets[:n]:
            if s and t and 100 * len(s & t) >= threshold * len(s | t):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return find


def check_components(few, rows, k, **options):
    df = few.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("x"))
    got = forest.near_duplicates(df, k=k, **options).collect()
    find = brute_components(rows, k)
    full = {i: len(shingles(t, k)) for i, t in rows if len(shingles(t, k))}
    assert Counter((r.id, r.n_shingles) for r in got) == Counter((i, len(shingles(t, k))) for i, t in rows)
    for r in got:
        if r.id in full and r.n_shingles:
            assert r.component_id == find(r.id) and r.kept == (r.component_id == r.id)
        else:
            assert r.kept and r.component_id == r.id


def test_near_dedup_on_odd_rows(few):
    check_components(few, [(r[0], r[1]) for r in odd_rows()], 4)


def test_near_dedup_in_crowded_regions(few):
    # copies of one text with 1 to 14 of 150 words changed, and a passage many texts share
    r, base, passage = random.Random(5), words(9, 150), words(10, 25)
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(1 + i % 14):
            w[r.randrange(150)] = f"v{r.randrange(9999)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(passage + words(100 + i, 30))) for i in range(80)]
    rows += [(2000 + i, rows[3][1].upper()) for i in range(40)]
    check_components(few, rows, 4, region=8, window=2)


def test_blocks_give_one_link_for_components_that_meet():
    # 30 copies in components of their own and 40 in one: joined by 30 links, not 30 * 69
    import pandas as pd

    one = np.arange(10, dtype=np.uint64).tobytes()
    other = np.arange(100, 110, dtype=np.uint64).tobytes()
    x = pd.DataFrame({"id": range(30), "c": range(30), "set": [one] * 30})
    y = pd.DataFrame({"id": range(71), "c": [*range(30), *[30] * 40, 70], "set": [one] * 70 + [other]})
    found = forest.block_links(x, y, 80)
    assert len(found) == 30
    label = dict(zip(y["id"], y["c"]))
    for _ in range(30):
        for a, b in zip(found["a"], found["b"]):
            low = min(label[a], label[b])
            label = {i: low if c in (label[a], label[b]) else c for i, c in label.items()}
    assert set(label.values()) == {0, 70}


def test_streamed_regions_lose_no_pair():
    # rows of one run cut between batches give the pairs of the whole run
    levels = np.array([[1, 1], [1, 1], [1, 2], [2, 5], [2, 5], [3, 1]])
    ids = np.array([5, 1, 9, 2, 8, 7])
    n, z = np.full(6, 10), np.zeros(6, dtype=np.int64)
    low, high, _, rows, _ = forest.region_pairs(levels, ids, n, z, z, 64, 8, 80)
    assert set(zip(low.tolist(), high.tolist())) == {(1, 5), (5, 9), (1, 9), (2, 8)} and len(rows) == 0
    low, high, _, rows, mark = forest.region_pairs(levels, ids, n, z, z, 1, 1, 80)
    assert set(zip(low.tolist(), high.tolist())) == {(1, 5), (2, 8)} and rows.tolist() == [0, 1, 3, 4]
    assert len(set(mark.tolist())) == 2


def test_a_region_that_is_cut_keeps_all_its_members(few):
    # more equal rows than are held at once: the tail is small, but part of the same large region
    rows = [(7, b"\0\0\0\1", i, 10, 0, 0, i) for i in range(63)] + [(9, b"\0\0\0\2", 100 + i, 10, 0, 0, 100 + i) for i in range(3)]
    df = few.createDataFrame(rows, "key long, path binary, id long, n long, s0 long, s1 long, component long").coalesce(1)
    before = few.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    few.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    for last in (60, 63, 66):
        got = forest.candidates(df.limit(last), region=8, window=4, threshold=80, hold=30).collect()
        members = {r.a for r in got if r.b is None}
        assert members == set(range(min(last, 63))) and len({r.region for r in got if r.b is None}) == 1
        assert {(r.a, r.b) for r in got if r.b is not None and r.a >= 100} == ({(100, 101), (100, 102), (101, 102)} if last == 66 else set())
    few.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_crowds_of_64_are_compared_pair_by_pair_by_default():
    # 40 classes share the first values only: one region, every pair a candidate
    options = inspect.signature(forest.near_duplicates).parameters
    region, window = options["region"].default, options["window"].default
    levels = np.column_stack([np.ones(40, np.int64), np.arange(40)])
    ids, n, z = np.arange(40), np.full(40, 10), np.zeros(40, dtype=np.int64)
    low, high, _, rows, _ = forest.region_pairs(levels, ids, n, z, z, region, window, 80)
    assert len(set(zip(low.tolist(), high.tolist()))) == 40 * 39 // 2 and not len(rows)
    # one partner a row in the first rounds, none inside a component
    low, high, _, _, _ = forest.region_pairs(levels, ids, n, z, z, region, window, 80, best=True)
    assert len(low) == 40 and set(low.tolist()) | set(high.tolist()) == set(range(40))
    low, high, _, _, _ = forest.region_pairs(levels, ids, n, z, z, region, window, 80, component=ids // 39 * 39)
    assert set(zip(low.tolist(), high.tolist())) == {(i, 39) for i in range(39)}


def test_deeper_levels_have_their_own_hash_values(few):
    # new first values of tree 1 change its key and no path of tree 0
    one = np.arange(16, dtype=np.uint32)
    two = one.copy()
    two[4:8] += 100
    df = few.createDataFrame([(1, 9, one.tobytes(), 1), (2, 9, two.tobytes(), 2)], "id long, n long, sig binary, component long")
    got = [sorted((bytes(r.path), r.key) for r in forest.orders(df, 2, 4, 4).filter(f"id = {i}").collect()) for i in (1, 2)]
    assert [p for p, _ in got[0]] == [p for p, _ in got[1]] and len({k for g in got for _, k in g}) == 3
    signed = forest.sign(few.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), "doc_id", "text", 4, 2, 4, 4)
    assert len(signed.first().sig) == 4 * 2 * (4 + 4)


def test_components_of_a_long_chain(few):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 101)]
    got = dict(map(tuple, components(few.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(61)) and got[100] == got[101] == 100


def brute_lines(rows, threshold=80, least=5):
    seen, gone = [], set()
    for i, t in sorted({(i, t) for i, t in rows if i is not None and t is not None}, key=lambda x: x[0]):
        for n, line in enumerate(t.split("\n")):
            s = frozenset(line.lower().split())
            if len(s) >= least:
                if any(100 * len(s & x) >= threshold * len(s | x) for x in seen):
                    gone.add((i, n))
                seen.append(s)
    return gone


def test_line_dedup_matches_brute_force(few, odd):
    r = random.Random(8)
    rows = [(x[0], x[1]) for x in odd_rows() if x[0] != 11]  # 11: characters that Python's split() treats otherwise
    base = words(30, 40)
    for i in range(60):  # near copies of one line, many per word group
        w = list(base)
        for _ in range(r.randrange(0, 9)):
            w[r.randrange(40)] = f"u{r.randrange(500)}"
        rows.append((500 + i, " ".join(w) + "\n" + " ".join(words(600 + i, 15, 60))))
    df = few.createDataFrame(rows, "doc_id long, text string")
    got = similar_lines(df, first_block=2)
    want = brute_lines(rows)
    assert Counter((x.doc_id, x.line_no) for x in got.collect()) == Counter(want)
    clean = dedup_lines(df.withColumns({"line_no": F.lit("x"), "n": F.lit("y")}), first_block=2)
    assert clean.columns == ["doc_id", "text", "line_no", "n"] and clean.count() == len(rows)
    expect = Counter((i, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in want)) for i, t in rows)
    assert Counter((x.doc_id, x.text) for x in clean.collect()) == expect


def test_line_words_are_cut_at_plain_spaces(few):
    from wideframe.llm import linedup
    from wideframe.llm.common import words_sql

    texts = ["a\tB  c\rD\x0be\x0cg ", "plain Words only", " \t\r", "", None, "x\x85y\u00a0z \u2028w\x1c1", "ÄÖ É\tİ ß"]
    df = few.createDataFrame([(x,) for x in texts], "line string")
    got = df.select(F.expr(f"array_remove({linedup.cut('line')}, '') AS cut"), F.expr(f"{words_sql('lower(line)')} AS words"),
                    F.expr(f"size({linedup.line_hashes('line')}) AS n")).collect()
    assert all((r.cut or []) == r.words and (r.n or 0) == len(set(r.words)) for r in got)


def test_short_lines_are_deduplicated(few):
    import corpus_pipeline as cp

    r = random.Random(4)
    rows = [(i, "\n".join(" ".join(f"w{r.randrange(5)}" for _ in range(r.randrange(7))) for _ in range(6))) for i in range(40)]
    rows += [(90, "And ornd.\n\none two three four"), (91, "and ornd.\n\none two three four five\n" + "la " * 50), (92, "la")]
    df = few.createDataFrame(rows, "doc_id long, text string")
    want = brute_lines(rows, least=1)
    got = similar_lines(df, min_tokens=1, first_block=2)
    assert Counter((x.doc_id, x.line_no) for x in got.collect()) == Counter(want)
    assert {(91, 0), (91, 2), (92, 0)} <= want and (91, 1) not in want
    clean = {x.doc_id: x.text for x in cp.lines(few, df, "").collect()}
    assert clean == {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in want) for i, t in rows}


def test_line_dedup_of_an_id_with_two_texts(few):
    a, b, c = "a b c d e f g h i j", "k l m n o p q r s t", "aa bb cc dd ee ff gg hh ii jj"
    rows = [(1, f"{a}\n{b}\n{c}"), (2, b), (2, f"{c} x"), (2, "one line of five other words"), (3, f"{a} y\n{b} z")]
    df = few.createDataFrame(rows, "doc_id long, text string")
    got = similar_lines(df)
    assert {(r.doc_id, r.line_no) for r in got.collect()} == {(2, 0), (3, 0), (3, 1)}
    clean = Counter((r.doc_id, r.text) for r in dedup_lines(df).collect())
    assert clean == Counter([rows[0], (2, ""), (2, ""), rows[3], (3, "")])
    # the words of a first place come from its own row: the shorter row has no such line
    rows = [(1, "x"), (1, f"u v w x y\n{a}"), (2, f"{a} z")]
    df = few.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.line_no) for r in similar_lines(df).collect()} == {(2, 0)}


def test_line_dedup_of_nothing(none):
    assert similar_lines(none).count() == 0 and dedup_lines(none).count() == 0


def test_url_rules_and_templates(few):
    rules = (UrlRule("allow", "com", "/"), UrlRule("block", "example.com", "/en/"), UrlRule("allow", "www.example.com", "/en/"),
             UrlRule("block", "net", "/es/"))
    urls = [None, "no url", "http://A.Example.COM/en/1?x=/y#z", "https://www.example.com/en/2", "x://example.com", "ftp://b.net/es/#q",
            "http://notexample.com/en/3", "http://b.net?x", "http://u:p@b.net:80/es/1", "http://e.org/caf\u00e9/../es/4", ""]
    want = [("", "", None), ("", "", None), ("a.example.com", "/en/1", "example.com/en/"), ("www.example.com", "/en/2", "www.example.com/en/"),
            ("example.com", "", None), ("b.net", "/es/", "net/es/"), ("notexample.com", "/en/3", "com/"), ("b.net", "", None),
            ("u:p@b.net:80", "/es/1", None), ("e.org", "/caf\u00e9/../es/4", None), ("", "", None)]
    rows = [(i, u) for i, u in enumerate(urls)]
    rows += [(100 + i, f"http://h{i % 5}.net/es/{i}") for i in range(40)] + [(200 + i, f"http://h{i % 5}.com/blog/post-{i}/") for i in range(40)]
    rows += [(300, "http://new.org/es/77"), (301, "http://new.org/blog/post-9/"), (302, "http://new.org/other"), (303, "http://s.org" + "/d" * 3000)]
    df = few.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("x"), "n": F.lit(1)})
    got = {r.page_id: r for r in filter_urls(df, rules).collect()}
    assert len(got) == len(rows)
    for i, w in enumerate(want):
        assert (got[i].host, got[i].path, got[i].rule) == w
    assert got[100].template == "/es/{n}" and got[200].template == "/blog/post-{n}/"
    assert [got[i].verdict for i in (300, 301, 302)] == ["block", "allow", "allow"]
    assert filter_urls(df.limit(0), rules).count() == 0


def test_branches_that_part_far_down_are_judged_apart(few):
    deep = "/a/b/c/d/e/f/g/h/i/j/k"
    rules = (UrlRule("block", "x.com", deep + "/bad/"), UrlRule("allow", "x.com", deep + "/ok/"))
    rows = [(2 * i + j, f"http://x.com{deep}/{s}/{i}") for i in range(20) for j, s in enumerate(("ok", "bad"))]
    rows += [(100, f"http://new.org{deep}/bad/7"), (101, f"http://new.org{deep}/ok/7"), (102, "http://new.org" + "/z" * 40)]
    got = {r.page_id: r for r in filter_urls(few.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert len(got) == len(rows) and (got[100].verdict, got[101].verdict) == ("block", "allow")
    assert got[100].template.endswith("/**") and got[102].template == "/z/z/z/z/z/z/z/**"


def test_url_segments_become_wildcards(few):
    rows = [(i, f"http://h.net/u/{chr(97 + i % 26)}{chr(97 + i // 26)}/home") for i in range(200)]
    rows += [(1000 + i, f"http://h.net/about/{'abc'[i % 3]}") for i in range(60)]
    got = {r.page_id: r.template for r in filter_urls(few.createDataFrame(rows, "page_id long, url string"), (), max_children=20).collect()}
    assert {got[i] for i in range(200)} == {"/u/*/home"} and {got[1000 + i] for i in range(3)} == {"/about/a", "/about/b", "/about/c"}


def test_language_model_counts_and_normalisation(few, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 2000)
    rows = [(r[0], r[1]) for r in odd_rows()]
    df = few.createDataFrame(rows, "doc_id long, text string").withColumns({"held": F.lit(1), "c": F.lit("x")})
    got = sorted(score_documents(df, top=40, dim=8).collect(), key=str)
    code = lambda t: (t or "").encode().lower().split() + [None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    count = Counter(w for i, t in rows if not held(i) for w in code(t))
    n, v = sum(count.values()), len(count)
    want = Counter((i, held(i), len(code(t)), sum(count[w] > 0 for w in code(t)),
                    round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in code(t)), 6)) for i, t in rows)
    assert Counter((r.id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n} and all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert score_documents(df.limit(0)).count() == 0


def test_model_probabilities_sum_to_one_and_learn():
    rng = np.random.default_rng(2)
    # two "languages": the next word depends on the language of the last ones
    docs = [np.r_[rng.integers(0, 10, 30) + 10 * (i % 2), 21].astype("<u2").tobytes() for i in range(600)]
    t, a, b, _ = lm.windows(docs, 22)
    counts = np.bincount(t, minlength=22).astype(float)
    model = lm.LogBilinear(counts, 8)
    for e in range(3):
        model.train(t, a, b, batch=256, seed=e)
    s1, s2, norm = model.tables()
    p = np.exp(s1[:, None, :] + s2[None, :, :] - norm[:, :, None])
    assert np.allclose(p.sum(axis=2), 1, atol=1e-4)
    unigram = np.log(counts / counts.sum())[t].mean()
    assert (s1[a, t] + s2[b, t] - norm[a, b]).mean() > unigram + 0.4


def test_windows_start_at_each_document():
    t, a, b, first = lm.windows([np.array(x, "<u2").tobytes() for x in ([1, 2, 3], [9], [4, 5])], 99)
    assert t.tolist() == [1, 2, 3, 9, 4, 5] and first.tolist() == [0, 3, 4]
    assert a.tolist() == [99, 1, 2, 99, 99, 4] and b.tolist() == [99, 99, 1, 99, 99, 99]


def test_pipeline_stages_against_brute_force(few, tmpdir_path):
    import corpus_pipeline as cp

    prose = lambda s: "\n".join(" ".join(f"{a} of the" for a in words(s + i, 12)) for i in range(4))
    rows = [(i, prose(10 * i), "en", f"s{i % 3}", 0) for i in range(20)]
    rows += [(100, rows[0][1], "en", "s0", 0), (101, prose(3000) + "\n" + rows[5][1].split("\n")[2], "en", "s1", 0),
             (102, None, "en", "s1", None), (103, "too short", "en", "s2", 9), (None, prose(5000), "en", None, 0)]
    few.createDataFrame(rows, DOCS).write.parquet(tmpdir_path + "/documents.parquet")
    docs, kept = few.read.parquet(tmpdir_path + "/documents.parquet"), []
    for name, stage in cp.STAGES[:-1]:
        docs = stage(few, docs, tmpdir_path)
        assert docs.columns == DOCS.names
        kept.append(sorted(map(tuple, docs.collect()), key=str))
        docs = few.createDataFrame(kept[-1], DOCS)
    assert {r[0] for r in kept[0]} == {*range(20), 100, 101, None}
    gone = brute_lines([(r[0], r[1]) for r in kept[0]])
    assert (100, 0) in gone and (101, 4) in gone
    assert {(r[0], r[1]) for r in kept[1]} == {(r[0], "\n".join(x for n, x in enumerate(r[1].split("\n")) if (r[0], n) not in gone)) for r in kept[0]}
    find = brute_components([(r[0], r[1]) for r in kept[1]], 5)
    assert {r[0] for r in kept[2]} == {r[0] for r in kept[1] if r[0] is None or find(r[0]) == r[0]}
    assert {r[0] for r in kept[3]} <= {r[0] for r in kept[2] if r[1]}
    pieces = cp.run(few, tmpdir_path).collect()
    assert {p.doc_id for p in pieces} == {r[0] for r in kept[3]}
    copies, tokens = Counter(r[0] for r in kept[3]), {p.doc_id: p.doc_tokens for p in pieces}
    assert sum(p.length for p in pieces) == sum(n * tokens[i] for i, n in copies.items())


def test_pipeline_keeps_null_ids_and_texts_of_a_repeated_id(few):
    import corpus_pipeline as cp

    rows = [(None, text(70, 60), "en", "a", 1), (None, text(71, 60), "en", "b", 1), (None, text(71, 60), "en", "b", 1),
            (5, text(72, 60), "en", "b", 1), (5, text(73, 60), "en", "a", 1), (5, text(72, 60), "en", "a", 1), (6, text(74, 60), None, None, None)]
    got = cp.near_dedup(few, few.createDataFrame(rows, DOCS), "")
    assert got.columns == DOCS.names
    assert Counter(map(tuple, got.collect())) == Counter(r for i, r in enumerate(rows) if i != 3)


def test_pipeline_on_an_empty_table(few, none, tmpdir_path):
    import corpus_pipeline as cp

    none.write.parquet(tmpdir_path + "/documents.parquet")
    assert cp.run(few, tmpdir_path).count() == 0


@pytest.mark.parametrize("name", ["op1_pareto_mix", "op3_ball_tree_top_k", "op4_lsh_forest", "op5_line_dedup",
                                  "op7_quality_rules", "op9_interleave_shards"])
def test_queries_match_sql(few, name):
    import duckdb

    from wideframe.llm.oracles import ORACLES
    from wideframe.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    a = QUERIES[name](few, sf).toPandas()
    b = con.execute(ORACLES[name]).df()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    key = lambda df: sorted(tuple(None if x != x or x is None else round(x, 6) if isinstance(x, float) else x for x in r) for r in
                            df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False))
    assert key(a) == key(b)
