"""Fill-in-the-middle transformation on piece tables.

A document becomes descriptors ``(buffer, start, end)`` over two immutable buffers: its UTF-8 text and the sentinels.
Cutting splits descriptors, an arrangement is a permutation of them, and the inverse permutation gives the text back.
No text is copied until an output is asked for; digests stream over the descriptors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from colonnade.llm.base import query, spread

#: Marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Percent of the texts that are rearranged, and percent of those with the suffix first.
RATE, SUFFIX_FIRST, SEED = 50, 80, 42
#: Descriptors after cutting: 0 prefix, 1 middle, 2 suffix, 3 to 5 the marks of prefix, suffix and middle; a form is an order of them.
FORMS = {"plain": (0, 1, 2), "psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}
MARKS = (PREFIX, SUFFIX, MIDDLE)


class PieceTable:
    """A sequence of ``(buffer, start, end)`` descriptors over ``buffers``, which are never changed."""

    def __init__(self, buffers: Sequence, pieces: Sequence[tuple[int, int, int]]):
        self.buffers, self.pieces = buffers, tuple(pieces)

    def cut(self, offsets: Sequence[int]) -> PieceTable:
        """The same sequence with a border at each byte offset (ascending); offsets may repeat and give empty pieces."""
        out, base, todo = [], 0, list(offsets)
        for b, start, end in self.pieces:
            while todo and todo[0] - base <= end - start:
                middle = start + todo.pop(0) - base
                out.append((b, start, middle))
                base += middle - start
                start = middle
            out.append((b, start, end))
            base += end - start
        return PieceTable(self.buffers, out)

    def arranged(self, order: Sequence[int]) -> PieceTable:
        """The pieces in another order."""
        return PieceTable(self.buffers, [self.pieces[i] for i in order])

    def restored(self, order: Sequence[int]) -> PieceTable:
        """What ``arranged(order)`` was made from."""
        out = [(0, 0, 0)] * len(order)
        for piece, i in zip(self.pieces, order):
            out[i] = piece
        return PieceTable(self.buffers, out)

    def __iter__(self) -> Iterator[memoryview]:
        views = [memoryview(b) for b in self.buffers]
        return (views[b][start:end] for b, start, end in self.pieces)

    def content(self) -> bytes:
        return b"".join(self)

    def digest(self) -> str:
        h = hashlib.sha256()
        for part in self:
            h.update(part)
        return h.hexdigest()


def unit_ends(text) -> np.ndarray:
    """Byte offsets where the units of a UTF-8 text end: a run of blanks and the run of other characters after it, or blanks at the end of the text."""
    b = np.frombuffer(text, np.uint8)
    if not len(b):
        return np.zeros(0, np.int64)
    other = (b != 32) & ((b < 9) | (b > 13))
    ends = np.flatnonzero(other[:-1] & ~other[1:]) + 1
    return np.append(ends, len(b))


def chars(text) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def choose(text: bytes, n: int, digits: str, rate: int, suffix_first: int) -> tuple[str, int, int]:
    """Form and the two cuts, in units, from 32 hex digits."""
    h = [int(digits[a : a + 8], 16) for a in (0, 8, 16, 24)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not n or h[2] % 100 >= rate or any(m in text for m in MARKS):
        return "plain", low, high
    return ("spm" if h[3] % 100 < suffix_first else "psm"), low, high


def transform(text: bytes, form: str, first: int, second: int) -> PieceTable:
    """The text in its form, cut at two byte offsets."""
    table = PieceTable((text,), [(0, 0, len(text))]).cut((first, second))
    marks, at = [], 0
    for m in MARKS:
        marks.append((1, at, at + len(m)))
        at += len(m)
    return PieceTable((text, b"".join(MARKS)), [*table.pieces, *marks]).arranged(FORMS[form])


def restore(output: bytes, form: str) -> PieceTable:
    """The text of an output, as pieces of the output: its marks are found, cut out and left aside."""
    whole = PieceTable((output,), [(0, 0, len(output))])
    if form == "plain":
        return whole
    order, cuts, at = FORMS[form], [], 0
    for i in order:
        if i >= 3:
            at = output.index(MARKS[i - 3], at)
            cuts += [at, at + len(MARKS[i - 3])]
            at = cuts[-1]
    pieces = whole.cut(cuts).pieces[1:]  # nothing stands before the first mark
    table = PieceTable((output,), pieces).restored(order)
    return PieceTable(table.buffers, table.pieces[:3])


COLUMNS = [("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output_sha256", "string"), ("restored_sha256", "string")]


def fill_in_middle(docs: DataFrame, keep: Sequence[str] | None = None, texts: bool = True, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """Rearrange ``text`` of ``docs`` by the hash of ``doc_id``: ``row`` (a struct of the ``keep`` columns, all by default, so no
    name clashes), ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` (null if plain), both digests and, with ``texts``, ``output``.

    A null text is empty; empty texts, blanks only and texts of any length are cut like others; a text that holds a
    mark stays plain. A null id hashes as no digits. Rows alike in id and text come out alike; no rows, no output.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    src = spread(docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), F.substring(key, 1, 32).alias("digits"), F.col("text").cast("string").alias("text")))
    added = [*COLUMNS, *([("output", "string")] if texts else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for digits, scalar in zip(b.column("digits").to_pylist(), b.column("text")):
                text = scalar.as_buffer().to_pybytes() if scalar.is_valid else b""
                ends = unit_ends(text)
                form, low, high = choose(text, len(ends), digits, rate, suffix_first)
                first, second = (int(ends[k - 1]) if k else 0 for k in (low, high))
                table = transform(text, form, first, second)
                result = table.content()
                counts = (None, None) if form == "plain" else (chars(text[:first]), chars(text[first:second]))
                out.append((len(ends), form, *counts, table.digest(), restore(result, form).digest(), *([result] if texts else [])))
            made = [pa.array(c, type={"long": pa.int64(), "string": pa.string()}[t]) for c, (_, t) in zip(list(zip(*out)) or [()] * len(added), added)]
            yield pa.RecordBatch.from_arrays([b.column("row"), *made], ["row", *(n for n, _ in added)])

    schema = StructType([src.schema["row"], *StructType.fromDDL(", ".join(f"{n} {t}" for n, t in added)).fields])
    return src.mapInArrow(run, schema)


_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_PART = lambda a, b: f"coalesce(array_to_string(list_slice(u, {a}, {b}), ''), '')"
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS u, sha256('{SEED}:' || coalesce(doc_id::varchar, '')) AS h FROM documents),
c AS (SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::bigint % (len(u) + 1) AS a, ('0x' || substr(h, 9, 8))::bigint % (len(u) + 1) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::bigint % 100 >= {RATE} THEN 'plain' WHEN ('0x' || substr(h, 25, 8))::bigint % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, {_PART(1, 'least(a, b)')} AS pre, {_PART('least(a, b) + 1', 'greatest(a, b)')} AS mid, {_PART('greatest(a, b) + 1', 'n')} AS suf FROM c)
SELECT doc_id, n::bigint AS n, form, CASE WHEN form <> 'plain' THEN length(pre)::bigint END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid)::bigint END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""


@query("op11_fill_in_middle", SQL)
def op11_fill_in_middle(t):
    """Form, cuts and digests of every document."""
    return fill_in_middle(t.documents, ["doc_id"], texts=False).select("row.doc_id", *[n for n, _ in COLUMNS])
