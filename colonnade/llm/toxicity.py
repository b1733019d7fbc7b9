"""Toxicity: a support vector machine over the gapped-subsequence string kernel, with Nyström landmarks.

The kernel of two words sums over all letter subsequences of length ``order`` that both hold, each
weighted by ``decay`` to the length it spans, gaps included, so an insult keeps most of its kernel
with a landmark when characters are put into it or left out. Landmarks are the words that tell toxic from clean
documents best (by a likelihood ratio over documents), some common clean ones and the clean ones that a first fit takes for
toxic; ``K_mm^(-1/2) k_m(x)`` are a word's features, and a linear machine with squared hinge loss is fitted on them, clean words inside the margin
being added from fit to fit. A sentence is as toxic as its worst word, a text as its
worst sentence; labels are on documents, so the words that they are blamed for are chosen first,
as in multiple-instance learning. Platt scaling on rows apart turns margins into scores.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from colonnade.llm.base import FOLDS, hashed_sample, held_out, query, spread

#: Labelled rows that a model learns from, of each class at most (chosen by the hash of their id).
SAMPLE_PER_CLASS = 2000
ORDER, DECAY = 3, 0.85
TOXIC_LANDMARKS, CLEAN_LANDMARKS, HARD_LANDMARKS = 256, 16, 128
#: Clean words of the first fit (the most common), those added after each further one (inside the margin, worst first), and fits.
COMMON, VIOLATORS, ROUNDS = 2000, 2000, 4
#: Letters of a unit; longer ones are cut into overlapping pieces that cover all of them.
PIECE, OVERLAP = 24, 12
#: Words whose margins a task remembers; beyond, it forgets them all and goes on.
MEMORY = 300_000
#: Texts worked on at once.
CHUNK = 256

_LETTERS = re.compile(r"[^\W\d_]+")
_SPACED = re.compile(r"(?<!\w)\w(?:[\W_]{1,3}\w){2,}(?!\w)")


def tokens(text: str) -> set[str]:
    """What a text is scored by: its blank-separated tokens, and runs of single letters with gaps between."""
    low = text.lower()
    out = set(low.split())
    out.update(_SPACED.findall(low))
    return out


def units(token: str) -> list[str]:
    """Letter runs of a token, and the token without what stands between them; long ones in pieces."""
    runs = _LETTERS.findall(token)
    if len(runs) > 1:
        runs.append("".join(runs))
    out = []
    for r in runs:
        if len(r) <= PIECE:
            out.append(r)
        else:
            out += [r[i : i + PIECE] for i in range(0, len(r) - OVERLAP, PIECE - OVERLAP)]
    return out


def _codes(words: list[str], width: int) -> np.ndarray:
    out = np.zeros((len(words), width), dtype=np.int32)
    for i, w in enumerate(words):
        out[i, : len(w)] = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), dtype=np.int32)
    return out


def _kernel(s: np.ndarray, t: np.ndarray, order: int, decay: float) -> np.ndarray:
    """Raw kernel of every row of ``s`` (words of one length) with the row(s) of ``t``: (w, 1 or m, length), zero-padded."""
    w, n = s.shape
    length, m = t.shape[2], t.shape[1]
    one, two = np.float32(decay), np.float32(decay * decay)
    total = np.zeros((w, m), dtype=np.float32)
    prefix = [np.ones((length, w, m), dtype=np.float32)] + [np.zeros((length, w, m), dtype=np.float32) for _ in range(order - 1)]
    tt = np.moveaxis(t, 2, 0)
    for j in range(n):
        match = (s[None, :, j, None] == tt).astype(np.float32) * two
        total += np.einsum("lwm,lwm->wm", match, prefix[-1])
        for i in range(order - 1, 0, -1):
            step = match * prefix[i - 1]
            prefix[i] *= one
            run = np.zeros((w, m), dtype=np.float32)
            for k in range(length - 1):
                run *= one
                run += step[k]
                prefix[i][k + 1] += run
    return total


def similarity(words: list[str], landmarks: list[str], order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Normalised kernel (1 for equal words) of every word with every landmark; words under ``order`` letters have 0."""
    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    if not words or not landmarks:
        return out
    width = max(map(len, landmarks))
    t = _codes(landmarks, width)
    own = np.array([_kernel(_codes([x], len(x)), _codes([x], len(x))[:, None], order, decay)[0, 0] for x in landmarks])
    length = np.array([len(x) for x in words])
    for n in np.unique(length[length >= order]):
        at = np.flatnonzero(length == n)
        for a in range(0, len(at), 1024):
            part = at[a : a + 1024]
            s = _codes([words[i] for i in part], n)
            self_ = _kernel(s, s[:, None], order, decay)
            out[part] = _kernel(s, np.where(t == 0, -1, t)[None], order, decay) / np.sqrt(np.maximum(self_ * own[None], 1e-30))
    return out


def _triples(word: str, decay: float = DECAY) -> dict[str, float]:
    """Weight of every subsequence of three letters in a word: the kernel's own features."""
    out: dict[str, float] = {}
    for i, j, k in combinations(range(len(word)), 3):
        key = word[i] + word[j] + word[k]
        out[key] = out.get(key, 0.0) + decay ** (k - i + 1)
    return out


class Folded:
    """A weighted sum of normalised kernels with landmarks, folded onto letter triples: a word costs look-ups for its own
    triples, whatever the number of landmarks. The value is the kernel's, only summed in another order."""

    def __init__(self, landmarks: list[str], beta: np.ndarray, decay: float = DECAY):
        total: dict[str, float] = {}
        for x, weight in zip(landmarks, beta):
            own = _triples(x, decay)
            norm = np.sqrt(sum(v * v for v in own.values()))
            for t, v in own.items():
                total[t] = total.get(t, 0.0) + float(weight) * v / norm
        letters = sorted({c for t in total for c in t})
        self.codes = np.array([ord(c) for c in letters] or [0], np.int32)
        place = {c: i + 1 for i, c in enumerate(letters)}  # 0: a letter of no landmark
        heads = {p: i + 1 for i, p in enumerate(sorted({t[:2] for t in total}))}
        self.pair = np.zeros((len(letters) + 1, len(letters) + 1), np.int32)
        self.third = np.zeros((len(heads) + 1, len(letters) + 1), np.float32)
        for h, i in heads.items():
            self.pair[place[h[0]], place[h[1]]] = i
        for t, v in total.items():
            self.third[heads[t[:2]], place[t[2]]] = v
        self.decay = decay

    def _letters(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at + 1, 0)

    def sums(self, words: list[str]) -> np.ndarray:
        """The weighted sum for every word; words under three letters have 0."""
        out = np.zeros(len(words), np.float32)
        length = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(length[length >= 3]).tolist():
            at = np.flatnonzero(length == n)
            for a in range(0, len(at), 4096):
                part = at[a : a + 4096]
                codes = _codes([words[i] for i in part], n)
                x, got = np.ascontiguousarray(self._letters(codes).T), np.zeros(len(part), np.float32)
                for i in range(n - 2):
                    for j in range(i + 1, n - 1):
                        head = self.pair[x[i], x[j]]
                        some = np.flatnonzero(head)
                        if not len(some):
                            continue
                        near, h = np.zeros(len(some), np.float32), head[some]
                        for k in range(j + 1, n):
                            near += self.third[h, x[k][some]] * np.float32(self.decay ** (k - i + 1))
                        got[some] += near
                hit = np.flatnonzero(got)
                if len(hit):
                    own = _kernel(codes[hit], codes[hit][:, None], 3, self.decay)[:, 0]
                    out[part[hit]] = got[hit] / np.sqrt(np.maximum(own, 1e-30))
        return out


@dataclass
class Model:
    """Margin of a word: kernels with the landmarks times ``beta``, plus ``bias``; score of a text: logistic of its largest margin."""

    landmarks: list[str]
    beta: np.ndarray
    bias: float
    slope: float
    shift: float

    def __post_init__(self):
        self.folded = Folded(self.landmarks, self.beta)

    def margins(self, words: list[str]) -> np.ndarray:
        return self.folded.sums(words) + np.float32(self.bias)

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -60, 60)))


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-5, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss: Newton steps, each a least-squares fit to the rows inside the margin."""
    x1 = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    weight = weight / weight.sum()
    ridge = penalty * np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-9
    w, open_ = np.zeros(x1.shape[1]), np.ones(len(x1), bool)
    for _ in range(rounds):
        a = x1[open_] * weight[open_, None]
        goal = np.linalg.solve(ridge + a.T @ x1[open_], a.T @ y[open_])
        loss = lambda v: v @ ridge @ v + weight @ np.maximum(0, 1 - y * (x1 @ v)) ** 2
        step = 1.0
        while step > 1e-3 and loss(w + step * (goal - w)) > loss(w):
            step /= 2
        w = w + step * (goal - w)
        new = y * (x1 @ w) < 1
        if np.array_equal(new, open_):
            break
        open_ = new
    return w[:-1], float(w[-1])


def _platt(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve over the margins, by Newton steps on smoothed targets; the slope stays positive."""
    pos, neg = int((y > 0).sum()), int((y <= 0).sum())
    goal = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, v = np.stack([f, np.ones_like(f)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        grad = x.T @ (p - goal) + 1e-3 * v
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), grad)
        v = v - np.clip(step, -2, 2)
    return max(float(v[0]), 1e-3), float(v[1])


def _originals(rows: list[tuple[bool, set[str]]], alike: float = 0.7, hashes: int = 12) -> Iterator[tuple[bool, set[str]]]:
    """Rows without near copies of an earlier row of their class, which would prove any word of theirs.

    A copy shares ``alike`` of its words (Jaccard) with one single earlier row; candidates have a third of their min-hashes in common.
    """
    number = {x: i for i, x in enumerate(sorted({x for _, u in rows for x in u}))}
    order = np.array([np.random.default_rng(k).permutation(len(number)) for k in range(hashes)]).reshape(hashes, -1)
    kept: dict[tuple[bool, int, int], list[int]] = {}
    sets: list[set[str]] = []
    for y, u in rows:
        if not u:
            yield y, u
            continue
        least = order[:, [number[x] for x in u]].min(axis=1).tolist()
        keys = [(y, k, m) for k, m in enumerate(least)]
        met = Counter(i for key in keys for i in kept.get(key, ()))
        if any(3 * c >= hashes and len(u & sets[i]) >= alike * len(u | sets[i]) for i, c in met.items()):
            continue
        for key in keys:
            kept.setdefault(key, []).append(len(sets))
        sets.append(u)
        yield y, u


def _evidence(pos: int, n_pos: int, neg: int, n_neg: int) -> float:
    """Log-likelihood ratio that a word in ``pos`` of ``n_pos`` toxic and ``neg`` of ``n_neg`` clean documents leans to the toxic ones; 0 unless strongly."""
    if pos * n_neg <= 4 * neg * n_pos:
        return 0.0
    total, n = pos + neg, n_pos + n_neg
    return 2 * (pos * np.log(pos * n / (total * n_pos)) + (neg * np.log(neg * n / (total * n_neg)) if neg else 0.0))


def _variants(word: str) -> list[tuple[str, float]]:
    """A blamed word, and with less weight the word with a letter put in, doubled or (if long enough) left out."""
    h = len(word) // 2
    out = [(word, 1.0), (f"{word[:h]}x{word[h:]}", 0.2), (word[: h + 1] + word[h:], 0.2)]
    return [*out, (word[:h] + word[h + 1 :], 0.2)] if len(word) > 4 else out


def _nystroem(landmarks: list[str], forms: list[tuple[str, float]], negative: list[str], in_neg: Counter) -> Model:
    """The machine on Nyström features, toxic forms against clean words, both weighed by their documents."""
    kmm = similarity(landmarks, landmarks).astype(np.float64)
    value, vector = np.linalg.eigh((kmm + kmm.T) / 2)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-5))) @ vector.T
    y = np.array([1.0] * len(forms) + [-1.0] * len(negative))
    weight = np.array([float(w) for _, w in forms] + [1.0 + in_neg[x] for x in negative])
    v, bias = _machine(similarity([x for x, _ in forms] + negative, landmarks) @ root, y, weight)
    return Model(landmarks, (root @ v).astype(np.float32), bias, 1.0, 0.0)


def fit(bags: Iterable[tuple[int, bool, list[str]]]) -> Model:
    """Learn from ``(toxic, for calibration, units)`` of documents. One class or no rows: a constant score."""
    rows = list(bags)
    learn = [(y, set(u)) for y, cal, u in rows if not cal]
    n_pos, n_neg = sum(y for y, _ in learn), sum(1 - y for y, _ in learn)
    if not n_pos or not n_neg:
        share = sum(y for y, _, _ in rows) / len(rows) if rows else 0.0
        return Model([], np.zeros(0), 0.0, 1.0, float(np.log((share + 0.01) / (1.01 - share))))
    in_pos, in_neg = Counter(), Counter()
    for y, u in _originals(learn):
        (in_pos if y else in_neg).update(x for x in u if len(x) >= ORDER)
    n_pos, n_neg = max(n_pos, 1), max(n_neg, 1)
    proof = {x: _evidence(c, n_pos, in_neg[x], n_neg) for x, c in in_pos.items()}
    least = 2 * np.log(len(proof) + 1) + 5  # so strong that no word of the sample is expected to reach it by chance
    toxic = sorted((x for x, g in proof.items() if g >= least), key=lambda x: (-proof[x], x))
    toxic = toxic or sorted(proof, key=lambda x: (-proof[x], x))[:4]
    blamed = {x: in_pos[x] for x in toxic}
    clean = [x for x in sorted(in_neg, key=lambda x: (-in_neg[x], x)) if x not in blamed]
    forms = [(v, blamed[x] * w) for x in toxic for v, w in _variants(x) if v not in in_neg]
    hard: list[str] = []
    negative = clean[:COMMON]
    for turn in range(ROUNDS):
        landmarks = list(dict.fromkeys(toxic[:TOXIC_LANDMARKS] + clean[:CLEAN_LANDMARKS] + hard[:HARD_LANDMARKS]))
        model = _nystroem(landmarks, forms, negative, in_neg)
        if turn + 1 < ROUNDS:  # clean words inside the margin that were not learned from yet
            margin = model.margins(clean)
            inside = sorted(np.flatnonzero(margin > -1).tolist(), key=lambda i: (-margin[i], clean[i]))
            hard = hard or [clean[i] for i in inside]
            negative = list(dict.fromkeys(negative + [clean[i] for i in inside[:VIOLATORS]]))
    known = sorted({x for _, _, u in rows for x in u})
    margin = dict(zip(known, model.margins(known).tolist()))
    rest = [(t, u) for t, cal, u in rows if cal] or [(t, u) for t, _, u in rows]
    if min(sum(t for t, _ in rest), sum(not t for t, _ in rest)) < 50:  # too few for a curve of their own
        rest = [(t, u) for t, _, u in rows]
    f = np.array([max((margin[x] for x in u), default=model.bias) for _, u in rest])
    model.slope, model.shift = _platt(f, np.array([t for t, _ in rest]))
    return model


class Scorer:
    """Largest margin of texts; margins of tokens are remembered within a bound."""

    def __init__(self, model: Model):
        self.model, self.memory = model, {}

    def margins(self, texts: list[str | None]) -> np.ndarray:
        bags = [tokens(x) if x else set() for x in texts]
        if len(self.memory) > MEMORY:
            self.memory.clear()
        new = set().union(*bags).difference(self.memory)
        own = {x: units(x) for x in new}
        distinct = list({u for us in own.values() for u in us})
        known = dict(zip(distinct, self.model.margins(distinct).tolist()))
        self.memory.update((x, max((known[u] for u in us), default=self.model.bias)) for x, us in own.items())
        return np.array([max(map(self.memory.__getitem__, b), default=self.model.bias) for b in bags])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on labelled documents that are not held out, at most ``per_class`` of each class, taken by the hash of their id.

    A null label or id teaches nothing; a document with several labels is toxic if one says so.
    The rows' distinct words, not their texts, reach the driver.
    """
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("y"))
    cal = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == FOLDS - 1).alias("cal")
    ids = hashed_sample(rows, "y", "doc_id", per_class).select("doc_id", "y", cal)
    src = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("y", "cal", "text")  # at most 2 x per_class ids

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [sorted({u for t in tokens(x or "") for u in units(t)}) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("y"), b.column("cal"), pa.array(own, type=pa.list_(pa.string()))], ["y", "cal", "units"])

    got = src.mapInArrow(bags, "y int, cal boolean, units array<string>").toArrow()
    return fit(sorted(zip(got["y"].to_pylist(), got["cal"].to_pylist(), got["units"].to_pylist()), key=lambda r: (r[0], r[2])))


def scores(docs: DataFrame, model: Model, keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns, all by default, so no name clashes) and ``score``. Null and empty texts score as a text without any word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            texts, f = b.column("text"), []
            for a in range(0, len(texts), CHUNK):
                f.append(scorer.margins(texts.slice(a, CHUNK).to_pylist()))
            own = model.score(np.concatenate(f)) if f else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(own, type=pa.float64())], ["row", "score"])

    src = spread(docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), F.col("text").cast("string").alias("text")))
    return src.mapInArrow(run, StructType([src.schema["row"], StructField("score", DoubleType())]))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay, clashing names too."""
    model = train(docs, labels, per_class)
    return scores(docs, model).filter(F.col("score") < threshold).select("row.*")


@query("op6_toxicity")
def op6_toxicity(t):
    """Score and decision for every document."""
    model = train(t.documents, t.labels)
    return scores(t.documents, model, ["doc_id"]).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
