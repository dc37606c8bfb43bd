"""Fill-in-middle transformation over seekable compressed frames (operator 12).

A text is stored as independent zstandard frames of at most ``units`` code
points, with the cumulative number of code points at the end of each frame
(``ends``). Any span of the text is then read by opening only the frames that
it touches: the frames at its two ends are decompressed and cut, the ones
between are taken as they are. A transformed text is such a list of frames
too: whole frames of the source move to their new place without being
compressed again, only cut ones are. Digests run over the frames in order, so
no more than one frame of a text is open at a time.

The cuts are drawn from sha256 of the document id (``draws``), so reruns and
retried tasks agree. The form is ``plain`` if the text is empty, holds a marker
or is drawn to stay; else ``spm`` or ``psm``. ``restore`` finds the markers in
the output by scanning its frames and puts the three spans back; a marker
cannot arise at a seam, because none is a suffix of text plus a beginning of
another marker.

Scale: no shuffle; the frames are stored once in the shared folder, and every
later pass works on rows of compressed frames. A retried task gives the same
rows.

Defined cases: null text is empty; a null id draws as the empty string; rows
that repeat an id are transformed each for itself; very long texts have many
frames; an empty table gives no rows; other columns of the input take no part
(they may have any name).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Code points of a frame.
UNITS = 16_384

FRAMES = "n long, ends array<long>, frames array<binary>"


class Frames:
    """Independent zstandard frames of one text with cumulative code points."""

    def __init__(self, ends=(), blobs=()):
        self.ends, self.blobs = list(ends), list(blobs)

    @classmethod
    def of(cls, text: str, units: int = UNITS) -> Frames:
        out = cls()
        for at in range(0, len(text), units):
            out.add(text[at:at + units])
        return out

    def add(self, text: str) -> None:
        """One more frame; an empty text adds none."""
        if text:
            self.put(len(text), _zstd().compress(text.encode()))

    def put(self, units: int, blob: bytes) -> None:
        self.ends.append(len(self) + units)
        self.blobs.append(blob)

    def __len__(self) -> int:
        return self.ends[-1] if self.ends else 0

    def open(self, i: int) -> bytes:
        return _zstd().decompress(self.blobs[i])

    def span(self, start: int, end: int):
        """The frames (units, blob) that make up text[start:end]: whole ones as
        they are, cut ones compressed anew."""
        i = bisect_right(self.ends, start)
        while start < end:
            low, high = self.ends[i - 1] if i else 0, self.ends[i]
            stop = min(end, high)
            if (start, stop) == (low, high):
                yield high - low, self.blobs[i]
            else:
                part = self.open(i).decode()[start - low:stop - low]
                yield len(part), _zstd().compress(part.encode())
            start, i = stop, i + 1

    def take(self, source: Frames, start: int, end: int) -> None:
        for units, blob in source.span(start, end):
            self.put(units, blob)

    def text(self, start: int = 0, end: int | None = None) -> str:
        """A selection as a string."""
        part = Frames()
        part.take(self, start, len(self) if end is None else end)
        return b"".join(map(part.open, range(len(part.blobs)))).decode()

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for i in range(len(self.blobs)):
            digest.update(self.open(i))
        return digest.hexdigest()

    def find(self, marker: str, start: int = 0) -> int:
        """Place of the first ``marker`` at or after ``start``, or -1; the end
        of a frame is carried over to the next, so markers across frames count."""
        i, tail = bisect_right(self.ends, start), ""
        while i < len(self.blobs):
            low = self.ends[i - 1] if i else 0
            text = self.open(i).decode()
            if low < start:
                text, low = text[start - low:], start
            at = (tail + text).find(marker)
            if at >= 0:
                return low - len(tail) + at
            tail, i = (tail + text)[1 - len(marker):], i + 1
        return -1


class _Zstd:
    def __init__(self):
        import zstandard

        self.compress = zstandard.ZstdCompressor(level=3).compress
        self.decompress = zstandard.ZstdDecompressor().decompress


_LOADED: list = []


def _zstd() -> _Zstd:
    """One compressor and decompressor per Python worker."""
    if not _LOADED:
        _LOADED.append(_Zstd())
    return _LOADED[0]


def draws(key: str) -> list[int]:
    """Four unsigned 32-bit numbers from sha256 of ``1:`` and the key."""
    h = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in (0, 8, 16, 24)]


def fill_in_middle(text: Frames, key: str, plain_from: int = 90, spm_below: int = 20):
    """(form, prefix length, middle length, output frames)."""
    n = len(text)
    h = draws(key)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not n or h[2] % 100 >= plain_from or any(text.find(m) >= 0 for m in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", None, None, text
    spans = {PREFIX: (0, a), SUFFIX: (b, n), MIDDLE: (a, b)}
    form = "spm" if h[3] % 100 < spm_below else "psm"
    out = Frames()
    for marker in ((SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)):
        out.add(marker)
        out.take(text, *spans[marker])
    return form, a, b - a, out


def restore(form: str, output: Frames) -> Frames:
    """The text from its output and form."""
    if form == "plain":
        return output
    second = PREFIX if form == "spm" else SUFFIX
    two = output.find(second, 3)
    three = output.find(MIDDLE, two + 3)
    first, other = (3, two), (two + 3, three)
    prefix, suffix = (other, first) if form == "spm" else (first, other)
    text = Frames()
    for span in (prefix, (three + 3, len(output)), suffix):
        text.take(output, *span)
    return text


def framed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", units: int = UNITS) -> DataFrame:
    """(id, n, ends, frames) of every row: the store that the others work on."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in (piece for whole in batches for piece in slices(whole, 1)):
            made = [Frames.of(t or "", units) for t in batch.column(1).to_pylist()]
            yield _batch([batch.column(0), pa.array([len(f) for f in made], pa.int64())], ["id", "n"], made)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id long, {FRAMES}")


def _batch(columns: list, names: list[str], made: list[Frames]) -> pa.RecordBatch:
    ends, blobs = [f.ends for f in made], [f.blobs for f in made]
    return pa.RecordBatch.from_arrays([*columns, pa.array(ends, pa.list_(pa.int64())), pa.array(blobs, pa.list_(pa.binary()))],
                                      names=[*names, "ends", "frames"])


def _few(batch: pa.RecordBatch, rows: int = 256):
    """The batch in pieces of few rows: frames become Python objects."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def transformed(store: DataFrame, plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, ends, frames): the outputs,
    again as frames, of a stored table of ``framed``."""
    ship(store.sparkSession)

    def run(batches):
        for batch in (piece for whole in batches for piece in _few(whole)):
            ids = batch.column(0).to_pylist()
            texts = [Frames(e, b) for e, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            done = [fill_in_middle(f, "" if i is None else str(i), plain_from, spm_below) for i, f in zip(ids, texts)]
            yield _batch([batch.column(0), batch.column(1), pa.array([d[0] for d in done], pa.string()),
                          pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
                         ["id", "n", "form", "prefix_chars", "middle_chars"], [d[3] for d in done])

    return store.select("id", "n", "ends", "frames").mapInArrow(
        run, "id long, n long, form string, prefix_chars long, middle_chars long, ends array<long>, frames array<binary>")


def digests(outputs: DataFrame) -> DataFrame:
    """``outputs`` of ``transformed`` with sha256 of the output and of the text
    rebuilt from it, without the frames."""
    ship(outputs.sparkSession)
    kept = ["id", "n", "form", "prefix_chars", "middle_chars"]

    def run(batches):
        for batch in (piece for whole in batches for piece in _few(whole)):
            made = [Frames(e, b) for e, b in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist())]
            forms = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array([f.sha256() for f in made], pa.string()),
                 pa.array([restore(form, f).sha256() for form, f in zip(forms, made)], pa.string())],
                names=[*kept, "output_sha256", "restored_sha256"])

    return outputs.select(*kept, "ends", "frames").mapInArrow(
        run, "id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")
