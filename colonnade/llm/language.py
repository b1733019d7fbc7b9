"""Language identification: averaged hashed subword embeddings under a linear softmax.

Every run of two to four characters of a text (lower-cased, blanks included, so word ends show) is
hashed to a row of an embedding table; their mean goes through a softmax layer. Both are trained by
stochastic gradient descent in numpy on a bounded sample; a temperature fitted on rows apart makes the
probabilities honest, and the probability under which too many of those rows were wrong rejects a
prediction (``accepted``). Applied, embedding and layer fold into one table of logits per bucket,
so a text of any length costs one pass over its characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from colonnade.llm.base import FOLDS, hashed_sample, held_out, query, spread

#: Rows that are learned from, for each language at most (chosen by the hash of their id).
SAMPLE_PER_LANGUAGE = 1000
BUCKET_BITS, DIMENSIONS = 15, 16
GRAMS = (2, 3, 4)
EPOCHS, RATE = 5, 0.5
#: Accuracy that the accepted predictions had on the rows apart.
ACCEPTED_ACCURACY = 0.98
#: Characters hashed at once.
CHUNK = 1 << 20

_LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


def buckets(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all character runs of a text, in bounded pieces; every run is in exactly one."""
    text = " " + text.lower() + " "
    for at in range(0, len(text), CHUNK):
        part = text[at : at + CHUNK + max(GRAMS) - 1]
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        h = np.full(len(c), 2166136261, dtype=np.uint32)
        for n in range(1, max(GRAMS) + 1):
            if len(c) < n:
                break
            h = (h[: len(c) - n + 1] ^ c[n - 1 :]) * np.uint32(16777619) + np.uint32(n)
            if n in GRAMS:
                x = h ^ (h >> np.uint32(15))
                yield ((x * np.uint32(2654435769)) >> np.uint32(32 - BUCKET_BITS))[:CHUNK]


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share of its runs in each."""
    total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for b in buckets(text):
        total += np.bincount(b, minlength=len(total))
    at = np.flatnonzero(total)
    return at.astype(np.int32), (total[at] / max(1, total.sum())).astype(np.float32)


@dataclass
class Model:
    """Logits of each bucket and language, temperature included."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    accept: float

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for b in buckets(text):
            total += np.bincount(b, minlength=len(self.table)) @ self.table if len(b) > len(self.table) else self.table[b].sum(axis=0, dtype=np.float64)
            n += len(b)
        return total / max(1, n) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        z = self.logits(text)
        p = np.exp(z - z.max())
        k = int(z.argmax())
        return self.languages[k], float(p[k] / p.sum())


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, bool, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """Learn from ``(language, for calibration, buckets, shares)``; no rows give a model that only says ``und``."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros(0), 1.0)
    index = {x: i for i, x in enumerate(languages)}
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    learn = [r for r in rows if not r[1]] or rows
    steps, done = EPOCHS * len(learn), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(learn)):
            lang, _, at, share = learn[k]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            mean = share @ emb[at]
            grad = _softmax(mean @ layer + bias)
            grad[index[lang]] -= 1
            back = layer @ grad
            layer -= rate * np.outer(mean, grad)
            bias -= np.float32(0.1) * rate * grad
            emb[at] -= (rate / (share @ share) * share)[:, None] * back[None, :]  # the text's mean moves by rate x gradient, whatever its length
    table = emb @ layer
    apart = [r for r in rows if r[1]]
    apart = apart if len(apart) >= 20 else rows
    z = np.stack([share @ table[at] + bias for _, _, at, share in apart])
    y = np.array([index[r[0]] for r in apart])
    loss = lambda t: -np.log(np.maximum(_softmax(z * t)[np.arange(len(y)), y], 1e-12)).mean()
    scale = min(np.geomspace(0.05, 3, 60), key=loss)
    p = _softmax(z * scale)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-top, kind="stable")
    good = np.cumsum(right[order]) >= ACCEPTED_ACCURACY * np.arange(1, len(y) + 1)
    accept = min(0.9, float(top[order][np.flatnonzero(good)[-1]])) if good.any() else 1.0  # all right: nothing says more than 0.9 is needed
    return Model(languages, (table * scale).astype(np.float32), bias * scale, accept)


def _arrays(lists: pa.ListArray) -> list[np.ndarray]:
    """The lists of an Arrow column as numpy views, not as Python objects."""
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on rows that are not held out, at most ``per_language`` of each language, taken by the hash of their id.

    Rows without text, letters, language or id teach nothing. Bucket shares, not texts, reach the driver.
    """
    own = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    ids = hashed_sample(own.filter(F.length("text") > 0).select("lang", "doc_id"), "lang", "doc_id", per_language).select("doc_id").distinct()
    cal = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == FOLDS - 1).alias("cal")
    src = own.join(F.broadcast(ids), "doc_id").select("lang", cal, "text")  # at most per_language ids for each language

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [counts(x or "") for x in b.column("text").to_pylist()]
            kept = pa.array([bool(x) and _LETTER.search(x) is not None for x in b.column("text").to_pylist()])
            cols = [b.column("lang"), b.column("cal"), pa.array([a for a, _ in got], pa.list_(pa.int32())), pa.array([s for _, s in got], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(cols, ["lang", "cal", "at", "share"]).filter(kept)

    got = src.mapInArrow(shares, "lang string, cal boolean, at array<int>, share array<float>").toArrow()
    rows = [
        (x, c, a, s)
        for b in got.to_batches()
        for x, c, a, s in zip(b.column("lang").to_pylist(), b.column("cal").to_pylist(), _arrays(b.column("at")), _arrays(b.column("share")))
    ]
    return fit(sorted(rows, key=lambda r: (r[0], r[2].tobytes(), r[3].tobytes(), r[1])))


def predictions(docs: DataFrame, model: Model, keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns, all by default, so no name clashes), ``lang_pred``, ``score`` and ``accepted``; null or letterless texts are ``und`` with score 0, not accepted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [model.predict(x.as_py()) for x in b.column("text")]
            score = np.array([s for _, s in got])
            cols = [pa.array([x for x, _ in got], pa.string()), pa.array(score, pa.float64()), pa.array([x != UNKNOWN and s >= model.accept for x, s in got], pa.bool_())]
            yield pa.RecordBatch.from_arrays([b.column("row"), *cols], ["row", "lang_pred", "score", "accepted"])

    src = spread(docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), F.col("text").cast("string").alias("text")))
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("accepted", BooleanType())]
    return src.mapInArrow(run, StructType([src.schema["row"], *added]))


@query("op5_language")
def op5_language(t):
    """Language of every document."""
    model = train(t.documents)
    return predictions(t.documents, model, ["doc_id"]).select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
