"""Token ids of whole texts by a public byte-level BPE vocabulary.

The ids equal those of ``tokenizers`` on the same vocabulary file with
``add_special_tokens=False``: a special string in a text is one id, and the text
before and after it is encoded apart. A text goes to the tokeniser whole; one
with a very long unbroken run is cut at every single space that stands between
two visible characters, a place that no token of a byte-level BPE spans, so that
only the run itself takes the slower way.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "byte_bpe_50k.json"
EOS = 1

#: The vocabulary's special string.
SPECIAL = "<|endoftext|>"

_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of a byte-level vocabulary: printable Latin-1
    bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TextIds:
    """Ids of texts (little-endian uint16 bytes). Holds the vocabulary only, so
    memory and time per text do not depend on the texts before."""

    #: Merging an unbroken run longer than this is quadratic in tiktoken.
    longest = 5_000

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        self.path = public_tokenizers.path(vocabulary)
        with open(self.path, encoding="utf-8") as f:
            told = json.load(f)
        vocab = told["model"]["vocab"]
        symbols = byte_symbols()
        ranks = {bytes(symbols[c] for c in t): i for t, i in vocab.items() if all(c in symbols for c in t)}
        self.special = {a["content"]: a["id"] for a in told["added_tokens"] if a["content"] == SPECIAL}
        for i in self.special.values():  # a special string is never merged to
            ranks = {t: k for t, k in ranks.items() if k != i}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = None

    def encode(self, text: str) -> bytes:
        if len(text) > self.longest:
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.path)
                self.slow.encode_special_tokens = True
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()
        return self.merged(text)

    def merged(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u2").tobytes()

    def has_long_run(self, text: str) -> bool:
        """Whether a run of visible characters or of white space may be long."""
        if len(text) <= self.longest:
            return False
        runs = list(map(len, text.split()))
        return max(runs, default=0) > self.longest or len(text) - sum(runs) - len(runs) > self.longest

    def text_ids(self, text: str) -> bytes:
        if not text:
            return b""
        if SPECIAL in text and self.special:
            mark = np.array([self.special[SPECIAL]], dtype="<u2").tobytes()
            return mark.join(map(self.text_ids, text.split(SPECIAL)))
        if not self.has_long_run(text):
            return self.merged(text)
        first, *rest = _INNER_SPACE.split(text)
        return self.encode(first) + b"".join(self.encode(" " + part) for part in rest)


_LOADED: dict[str, TextIds] = {}


def text_table(vocabulary: str) -> TextIds:
    """One table per Python worker and vocabulary."""
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = TextIds(vocabulary)
    return _LOADED[vocabulary]


def tokenised(docs: DataFrame, id_col: str, text_col: str, group_col: str | None = None,
              vocabulary: str = VOCABULARY, eos: int = EOS) -> DataFrame:
    """Rows (id, g, part, start, n, ids): uint16 ids of the whole text and an
    end id. ``part`` is the task and ``start`` the number of ids of the same
    group ``g`` before this document in the task, so per-task totals are enough
    to place every document in its group's stream. Null text is empty.

    ``part`` and ``start`` depend on how the input is split into tasks: store
    the result once and let every later pass read it."""
    from pyspark.sql import functions as F

    from .common import group_key, ship, slices

    ship(docs.sparkSession)
    end = np.array([eos], dtype="<u2").tobytes()

    def run(batches):
        from pyspark import TaskContext

        table, part, before = text_table(vocabulary), TaskContext.get().partitionId(), {}
        for batch in (piece for whole in batches for piece in slices(whole, 2)):
            ids, starts = [], []
            groups = batch.column(1).to_pylist()
            for g, text in zip(groups, batch.column(2).to_pylist()):
                ids.append(table.text_ids(text or "") + end)
                starts.append(before.get(g, 0))
                before[g] = starts[-1] + len(ids[-1]) // 2
            n = [len(x) // 2 for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(groups, pa.string()), pa.array([part] * len(ids), pa.int32()),
                 pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                names=["id", "g", "part", "start", "n", "ids"])

    key = F.expr(group_key(group_col)) if group_col else F.lit("")
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), key.alias("g"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "id long, g string, part int, start long, n long, ids binary")
