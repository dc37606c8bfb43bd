"""Quality rules, mix, sharding, packing and training order on odd rows."""

import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from wideframe.llm import order
from wideframe.llm.common import n_words_sql
from wideframe.llm.mix import cycled_weights, pareto_mix, targets
from wideframe.llm.order import feistel, materialise, read_slots
from wideframe.llm.pack import pack, queue_table, unit_places
from wideframe.llm.quality import judge
from wideframe.llm.shard import interleave_shards

from odd_docs import odd_rows

W = re.compile(r"[^\x20\x09-\x0D]+")


def test_quality_metrics_match_brute_force(odd):
    got = judge(odd.withColumn("kept", F.lit("x")).withColumn("n_words", F.lit("y"))).collect()
    want = Counter()
    for r in odd_rows():
        t = r[1] or ""
        w = W.findall(t)
        lines = [x for x in t.split("\n") if W.search(x)]
        win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        cover = {i + j for i in range(len(w) - 7) if win[tuple(w[i:i + 8])] > 1 for j in range(8)}
        want[(r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover))] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept) and (r.failed_rules == "") == r.kept


def test_quality_keeps_prose_and_rejects_junk(few):
    prose = ("The cat sat on the mat and it was not afraid of the dog that lived in the house. "
             "For all of us who were there, the rest of the day is lost, but by the sea it was warm and still.")
    junk = " ".join(f"word{i}%%&" for i in range(60))
    rows = [(1, prose), (2, junk), (3, "a b"), (4, "the same words over and over now " * 20)]
    got = {r.doc_id: r.failed_rules for r in judge(few.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == "" and "symbols" in got[2] and got[3].startswith("few_words") and "repeated_windows" in got[4]


def sized(docs):
    return docs.select("*", F.expr(n_words_sql("text")).alias("size"))


def test_mix_reaches_targets_and_reruns_agree(odd):
    docs = sized(odd).withColumns({"copies": F.lit("c"), "target": F.lit("t")})
    a, b = (sorted(map(tuple, pareto_mix(docs, "size").select("doc_id", "source", "size", "target", "taken", "copies").collect()), key=str)
            for _ in range(2))
    assert a == b and len(a) == len(odd_rows())
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for _, s, n, t, k, c in a:
        assert k == c * n and k <= 3 * n
        size[s] += n
        taken[s] += k
        target[s] = t
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6
    for s in size:
        largest = max(n for _, x, n, *_ in a if x == s)
        assert target[s] <= 3 * size[s] + 1e-9
        assert abs(taken[s] - target[s]) <= largest


def test_targets_reshare_the_excess():
    got = targets({"a": 10, "b": 100, None: 0}, cycled_weights(["a", "b", None]), 110)
    assert got == {"a": Fraction(30), "b": Fraction(80), None: Fraction(0)}
    assert cycled_weights(["b", None, "a", "c"]) == {"a": 5, "b": 2, "c": 1, None: 5}


def test_shards_hold_the_mixture(few, odd):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(700)]
    got = interleave_shards(few.createDataFrame(rows, "doc_id long, source string").withColumn("slot", F.lit("x")), 8).collect()
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    of_source = Counter(r.source for r in got)
    per = Counter((r.shard, r.source) for r in got)
    assert all(abs(per[s, x] - of_source[x] / 8) < 2 for s in range(8) for x in of_source)
    small = interleave_shards(odd, 8, ("doc_id", "text")).collect()
    c = Counter(r.shard for r in small)
    assert len(small) == len(odd_rows()) and max(c.values()) - min(c.values()) <= 1


def public_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [np.array(e.ids + [1], dtype="<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_unit_places_are_a_gapless_order():
    totals = {"a": 1000, "b": 77, "c": 5, "d": 300}
    for weights in (None, {"a": 1, "b": 5, "c": 1, "d": 1}):
        _, w, units, last = queue_table(totals, 16, weights)
        queue = np.repeat(np.arange(len(units)), units)
        k = np.concatenate([np.arange(u) for u in units])
        size = np.where(k == units[queue] - 1, last[queue], 16)
        at = np.argsort(unit_places(queue, k, w, units, last, 16))
        place = unit_places(queue, k, w, units, last, 16)[at]
        assert (place == np.r_[0, np.cumsum(size[at])[:-1]]).all()


def test_a_text_is_encoded_by_one_call_unless_a_run_is_very_long():
    from types import SimpleNamespace

    from wideframe.llm import tokens

    tokens._LOADED.clear()
    table = next(f for n, f in vars(tokens).items() if n in ("text_table", "word_ids"))(tokens.VOCABULARY)
    calls, encoding = [], table.encoding
    table.encoding = SimpleNamespace(encode_ordinary=lambda t: calls.append(t) or encoding.encode_ordinary(t))
    texts = [" ".join(f"word{i} x{i * j}" for i in range(300)) for j in range(3)]
    texts += ["a  b\t" + "y" * 6000 + " c  d", " " * 6000 + "z", "ab " * 3000 + "q" * 5001 + "\n", "x<|endoftext|> y"]
    got = [np.frombuffer(table.text_ids(t), "<u2").tolist() + [1] for t in texts]
    tokens._LOADED.clear()
    assert got == [x.tolist() for x in public_ids(texts)]
    assert [calls.count(t) for t in texts[:3]] == [1, 1, 1]


def test_packing_round_trip(odd):
    pieces = pack(odd.withColumns({"ids": F.lit("i"), "n": F.lit(1), "g": F.lit("q")}), seq_len=256, quantum=32).collect()
    want = Counter(x.tobytes() for x in public_ids(r[1] for r in odd_rows()))
    by_sequence = defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        by_sequence[p.sequence_id].append(p)
    for s, ps in by_sequence.items():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == np.r_[0, np.cumsum([p.length for p in ps])[:-1]].tolist()
        assert s == max(by_sequence) or sum(p.length for p in ps) == 256
    by_id = defaultdict(list)
    for p in pieces:
        by_id[p.doc_id].append(p)
    for r, ids in zip(odd_rows(), public_ids(r[1] for r in odd_rows())):
        if r[0] is not None and r[0] != 10:
            assert b"".join(p.ids for p in sorted(by_id[r[0]], key=lambda p: p.start)) == ids.tobytes()
            assert {p.doc_tokens for p in by_id[r[0]]} == {len(ids)}
    assert sum(p.length for p in pieces) == sum(len(k) // 4 * n for k, n in want.items())


def test_packing_follows_target_shares(few):
    rows = [(i, "word " * 50, "big" if i % 4 else "small") for i in range(200)]
    docs = few.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = pack(docs, seq_len=128, quantum=16, weights={"big": 1, "small": 1}).collect()
    early = [p for p in pieces if p.sequence_id < 10]
    share = sum(p.length for p in early if p.source == "small") / sum(p.length for p in early)
    assert abs(share - 0.5) < 0.02


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 4097])
def test_feistel_is_a_permutation(n):
    a = feistel(np.arange(n), n, 5)
    assert sorted(a) == list(range(n))
    if n > 100:
        assert (a != feistel(np.arange(n), n, 6)).any() and (a != np.arange(n)).any()


def test_training_order_files_hold_every_id(odd, tmpdir_path):
    path = tmpdir_path + "/slots"
    got = sorted(materialise(odd, path, seq_len=64, per_shard=32).collect(), key=lambda r: r.slot)
    n = len(got)
    assert [r.slot for r in got] == list(range(n)) and all((r.shard, r.record) == divmod(r.slot, 32) for r in got)
    records = read_slots(path, 0, n + 5, 64, 32)
    assert records.shape == (n, 64)
    for r in got:
        assert zlib.crc32(records[r.slot, :r.n_ids].astype("<u4").tobytes()) == r.ids_crc32
    assert (read_slots(path, 40, 9, 64, 32) == records[40:49]).all()
    want = Counter(i for x in public_ids(r[1] for r in odd_rows()) for i in x.tolist())
    assert Counter(i for r in got for i in records[r.slot, :r.n_ids].tolist()) == want
    assert {d for r in got for d in r.doc_ids} == {-1 if r[0] is None else r[0] for r in odd_rows()}


def test_empty_tables(none):
    assert judge(none).count() == 0
    assert pareto_mix(sized(none), "size").count() == 0
    assert interleave_shards(none, 8).count() == 0
    assert pack(none).count() == 0
    assert order.materialise(none).count() == 0
