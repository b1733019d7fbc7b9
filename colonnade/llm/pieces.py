"""SentencePiece encoding and decoding with the N best segmentations.

Over the lattice of a text's pieces, a forward Viterbi pass gives every position the best score of what
lies before it. A search from the end then takes these as exact heuristics (A-star): the hypothesis with
the best sum of its own pieces and the heuristic is always the next to be finished, so
segmentations come out in order of their scores. No piece crosses from a character to a blank,
so the lattice is a chain of words; the segmentation of a word is found once for many uses, and the N best
of a text are combined from the N best of the words that lose least by a second choice.

Scores are integers (a logarithm times 2^20), so sums don't depend on their order and ties are real. Ties:
longer pieces first, seen from the end of a word; of two texts, the one that deviates later first.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from colonnade.llm.base import query, spread

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK, OWN_BLANK = 0x2581, 0x110000  # the blank's mark; the same character in a text, which no piece may take for a blank
UNIT, NONE = 1 << 20, -(1 << 62)
#: Words that a task remembers (beyond, it forgets all and goes on); texts worked on at once; words of a length done together, up to LONG characters.
MEMORY, CHUNK, GROUP, LONG = 300_000, 128, 4096, 48
_MULTIPLIER, _GOLDEN = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F
TABLE_BITS = 18


@dataclass
class Vocabulary:
    """Pieces of a model with integer scores. ``kind`` says where scores come from, see :func:`load`."""

    pieces: dict[str, int]
    scores: np.ndarray
    spelled: list[bytes]
    byte_ids: list[int] | None
    unknown: int
    unknown_score: int
    prefix: bool = True
    longest: int = field(init=False)

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)
        if any("▁" in p.lstrip("▁") for p in self.pieces):
            raise ValueError("a piece crosses from a character to a blank; words can't be told apart")
        plain = not any("\n" in p for p in self.pieces)
        self.word = re.compile(r"\n| *[^ \n]+| +" if plain else r" *[^ ]+| +")
        self.hashes = np.zeros(1 << TABLE_BITS, np.uint64)
        self.ids = np.full(1 << TABLE_BITS, -1, np.int32)
        self.probes = 1
        for p, i in self.pieces.items():
            h = 0
            for c in p:
                h = (h * _MULTIPLIER + ord(c) + 1) & (1 << 64) - 1
            s, n = (h * _GOLDEN & (1 << 64) - 1) >> 64 - TABLE_BITS, 1
            while self.ids[s] >= 0:
                s, n = (s + 1) % len(self.ids), n + 1
            self.hashes[s], self.ids[s], self.probes = h, i, max(self.probes, n)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Ids of the strings with these hashes, -1 for strings that are no piece."""
        s = ((h * np.uint64(_GOLDEN)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        out = np.where(self.hashes[s] == h, self.ids[s], -1)
        open_ = np.flatnonzero((out < 0) & (self.ids[s] >= 0))
        for k in range(1, self.probes):
            at = (s.flat[open_] + k) % len(self.ids)
            hit = self.hashes[at] == h.flat[open_]
            out.flat[open_[hit]] = self.ids[at[hit]]
            open_ = open_[~hit & (self.ids[at] >= 0)]
        return out

    def spans(self, *words: str) -> dict[int, np.ndarray]:
        """For every length ``k``, ids of the pieces that start at each place of words of one length (a row each), -1 for none."""
        w, n = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(w, n).astype(np.uint64)
        codes = np.where(codes == BLANK, OWN_BLANK, np.where(codes == 32, BLANK, codes)).astype(np.uint64) + np.uint64(1)
        h, ids = np.zeros((w, n), np.uint64), {}
        for k in range(1, min(self.longest, n) + 1):
            h = h[:, : n - k + 1] * np.uint64(_MULTIPLIER) + codes[:, k - 1 :]
            ids[k] = self.find(np.ascontiguousarray(h))
        return ids

    def expand(self, char: str) -> list[int]:
        """Ids of a character that is no piece: its bytes, or the unknown piece."""
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown]


def load(path: str = MODEL, scores: str = "rank") -> Vocabulary:
    """Read a model file. ``scores="stored"`` takes the piece scores as log-probabilities, as for a unigram
    model. The scores of a byte-pair model are ranks of merges; ``"rank"`` turns rank r into ``-ln(r H)``, the
    logarithm of Zipf's law. Nothing is trained. A character that is no piece costs 10 more than the worst piece."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.vocab_size()
    normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    value = np.full(n, 0.0)
    if scores == "rank":
        value[normal] = -np.log(np.arange(1, len(normal) + 1) * (np.log(len(normal)) + 0.5772156649))
    else:
        value[normal] = [sp.get_score(i) for i in normal]
    whole = np.round(value * UNIT).astype(np.int64)
    spelled = [b""] * n
    for i in normal:
        spelled[i] = sp.id_to_piece(i).replace("▁", " ").encode()
    byte_ids = [i for i in range(n) if sp.is_byte(i)]
    for i in byte_ids:
        spelled[i] = bytes([int(sp.id_to_piece(i)[3:5], 16)])
    spelled[sp.unk_id()] = " ⁇ ".encode()
    order = sorted(byte_ids, key=lambda i: spelled[i]) if len(byte_ids) == 256 else None
    least = int(min((whole[i] for i in normal), default=0))
    return Vocabulary({sp.id_to_piece(i): i for i in normal}, whole, spelled, order, sp.unk_id(), least - 10 * UNIT, sp.normalize("a") != "a")



def lattice(word: str, v: Vocabulary) -> list[list[tuple[int, int, int]]]:
    """For every end position the arcs ``(length, id, score)`` of a word, longest first; id -1 is a character that is no piece."""
    arcs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(word) + 1)]
    if len(word) <= LONG:  # look-ups one by one are quicker than a table of hashes
        text = ["▁" if c == " " else (None if c == "▁" else c) for c in word]
        for end in range(1, len(text) + 1):
            for n in range(min(v.longest, end), 0, -1):
                part = text[end - n : end]
                i = -1 if None in part else v.pieces.get("".join(part), -1)
                if i >= 0:
                    arcs[end].append((n, i, int(v.scores[i])))
                elif n == 1:
                    arcs[end].append((1, -1, v.unknown_score))
        return arcs
    ids = v.spans(word)
    for k in sorted(ids, reverse=True):
        own, at = ids[k][0], np.flatnonzero(ids[k][0] >= 0)
        for start, i, s in zip(at.tolist(), own[at].tolist(), v.scores[own[at]].tolist()):
            arcs[start + k].append((k, i, int(s)))
        if k == 1:
            for start in np.flatnonzero(own < 0).tolist():
                arcs[start + 1].append((1, -1, v.unknown_score))
    return arcs


class _Paths:
    """Hypotheses of the search as back pointers: piece, parent, depth and a farther ancestor to compare two of them in few steps."""

    def __init__(self) -> None:
        self.parent, self.far, self.depth, self.length, self.id = [0], [0], [0], [0], [-1]

    def add(self, parent: int, length: int, i: int) -> int:
        far = self.far[parent]
        same = self.depth[parent] - self.depth[far] == self.depth[far] - self.depth[self.far[far]]
        self.far.append(self.far[far] if same else parent)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.length.append(length)
        self.id.append(i)
        return len(self.parent) - 1

    def _at(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            node = self.far[node] if self.depth[self.far[node]] >= depth else self.parent[node]
        return node

    def before(self, a: int, b: int) -> bool:
        """Whether ``a`` comes first of two equal scores: at their first difference, seen from the end of the word, the longer piece; a prefix before its extension."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._at(a, depth), self._at(b, depth)
        if x == y:
            return self.depth[a] < self.depth[b]
        while self.parent[x] != self.parent[y]:
            if self.far[x] != self.far[y]:
                x, y = self.far[x], self.far[y]
            else:
                x, y = self.parent[x], self.parent[y]
        return self.length[x] > self.length[y]


class _Open:
    """A hypothesis in the heap, ordered by what it can reach at best, then by its path."""

    __slots__ = ("rest", "node", "at", "own", "paths")

    def __init__(self, rest: int, node: int, at: int, own: int, paths: _Paths):
        self.rest, self.node, self.at, self.own, self.paths = rest, node, at, own, paths

    def __lt__(self, other: _Open) -> bool:
        return self.rest < other.rest if self.rest != other.rest else self.paths.before(self.node, other.node)


def n_best(word: str, v: Vocabulary, n: int) -> list[tuple[int, list[int]]]:
    """The ``n`` best ``(score, ids)`` of a word, best first: forward Viterbi, then A-star from the end."""
    arcs = lattice(word, v)
    ahead = [0] + [NONE] * len(word)
    for end in range(1, len(word) + 1):
        ahead[end] = max(ahead[end - k] + s for k, _, s in arcs[end])
    if len(word) <= LONG:
        return _n_best_short(word, v, n, arcs, ahead)
    paths = _Paths()
    heap = [_Open(-ahead[-1], 0, len(word), 0, paths)]
    out = []
    while heap and len(out) < n:
        top = heapq.heappop(heap)
        if top.at == 0:
            ids, node, start = [], top.node, 0
            while node:
                i = paths.id[node]
                ids += v.expand(word[start]) if i < 0 else [i]
                start, node = start + paths.length[node], paths.parent[node]
            out.append((-top.rest, ids))
            continue
        for k, i, s in arcs[top.at]:
            heapq.heappush(heap, _Open(-(top.own + s + ahead[top.at - k]), paths.add(top.node, k, i), top.at - k, top.own + s, paths))
    return out


def _n_best_short(word: str, v: Vocabulary, n: int, arcs: list[list[tuple[int, int, int]]], ahead: list[int]) -> list[tuple[int, list[int]]]:
    """The same search with the whole path in every hypothesis, which is quicker while paths are short; tuples compare in the order of ``_Paths.before``."""
    heap: list[tuple[int, tuple[int, ...], int, int, tuple[int, ...]]] = [(-ahead[-1], (), len(word), 0, ())]
    out = []
    while heap and len(out) < n:
        rest, cut, at, own, path = heapq.heappop(heap)
        if at == 0:
            ids, start = [], 0
            for k, i in zip(reversed(cut), reversed(path)):
                ids += v.expand(word[start]) if i < 0 else [i]
                start -= k
            out.append((-rest, ids))
            continue
        for k, i, s in arcs[at]:
            heapq.heappush(heap, (-(own + s + ahead[at - k]), (*cut, -k), at - k, own + s, (*path, i)))
    return out


class Encoder:
    """Best ids of words, found for many words of one length at once, and the N best of texts."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.n_words = self.n_ids = 0
        self.ids = np.zeros(1 << 16, np.int32)
        self.begin, self.count, self.gap, self.score = (np.zeros(1 << 14, np.int64) for _ in range(4))
        self.lists: dict[tuple[str, int], list[tuple[int, list[int]]]] = {}

    def _store(self, words: list[str], ids: np.ndarray, count: np.ndarray, score: np.ndarray, gap: np.ndarray) -> None:
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n_words + len(words) > len(self.begin):
            self.begin, self.count, self.gap, self.score = (np.concatenate([a, np.zeros_like(a)]) for a in (self.begin, self.count, self.gap, self.score))
        at = slice(self.n_words, self.n_words + len(words))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.count[at], self.gap[at], self.score[at] = count, gap, score
        self.begin[at] = self.n_ids + np.cumsum(count) - count
        self.index.update(zip(words, range(self.n_words, self.n_words + len(words))))
        self.n_words, self.n_ids = self.n_words + len(words), self.n_ids + len(ids)

    def _alone(self, word: str) -> None:
        """A long word: the same pass, position by position."""
        arcs, v = lattice(word, self.v), self.v
        best, loss, last = [0] + [NONE] * len(word), [0] * (len(word) + 1), [(0, 0)] * (len(word) + 1)
        for end in range(1, len(word) + 1):
            second = NONE
            for k, i, s in arcs[end]:
                c = best[end - k] + s
                if c > best[end]:
                    second, best[end], last[end] = best[end], c, (k, i)
                else:
                    second = max(second, c)
            loss[end] = best[end] - second
        at, ids, gap = len(word), [], 1 << 62
        while at:
            k, i = last[at]
            gap = min(gap, loss[at])
            ids.append(v.expand(word[at - 1]) if i < 0 else [i])
            at -= k
        flat = np.array([i for part in reversed(ids) for i in part], np.int32)
        self._store([word], flat, np.array([len(flat)]), np.array([best[-1]]), np.array([gap]))

    def _together(self, words: list[str], n: int) -> None:
        """Words of one length: a forward Viterbi pass with the best and the second-best way to every position."""
        v, w = self.v, len(words)
        ids = v.spans(*words)
        cost = {k: np.where(x >= 0, v.scores[x], v.unknown_score if k == 1 else NONE // 2) for k, x in ids.items()}
        best, loss, last = np.zeros((n + 1, w), np.int64), np.zeros((n + 1, w), np.int64), np.zeros((n + 1, w), np.int64)
        for end in range(1, n + 1):
            top, second, took = np.full(w, NONE), np.full(w, NONE), np.zeros(w, np.int64)
            for k in range(min(v.longest, end), 0, -1):
                c = best[end - k] + cost[k][:, end - k]
                up = c > top
                second = np.where(up, top, np.maximum(second, c))
                top, took = np.where(up, c, top), np.where(up, k, took)
            best[end], loss[end], last[end] = top, top - second, took
        out, used = np.full((w, n), -1, np.int32), np.zeros((w, n), bool)
        at, gap, rows = np.full(w, n), np.full(w, 1 << 62), np.arange(w)
        table = np.full((min(v.longest, n) + 1, w, n), -1, np.int32)
        for k, x in ids.items():
            table[k, :, : n - k + 1] = x
        for column in range(n - 1, -1, -1):
            go = at > 0
            if not go.any():
                break
            k = last[at, rows]
            gap = np.where(go, np.minimum(gap, loss[at, rows]), gap)
            start = np.where(go, at - k, 0)
            out[:, column] = np.where(go, table[k, rows, start], -1)
            used[:, column] = go
            at = start
        odd = (used & (out < 0)).any(axis=1)
        plain = np.flatnonzero(~odd)
        self._store([words[i] for i in plain], out[plain][used[plain]], used[plain].sum(axis=1), best[n][plain], gap[plain])
        for i in np.flatnonzero(odd):
            self._alone(words[i])

    def learn(self, words: list[str]) -> None:
        by: dict[int, list[str]] = {}
        for x in words:
            by.setdefault(len(x), []).append(x)
        for n, own in by.items():
            if n > LONG:
                for x in own:
                    self._alone(x)
            else:
                for a in range(0, len(own), GROUP):
                    self._together(own[a : a + GROUP], n)

    def encode(self, texts: list[str], n: int = 1) -> tuple[np.ndarray, np.ndarray, list[int], list[list[tuple[int, list[tuple[int, int, list[int]]]]]]]:
        """All ids one after another, ids per text, score per text, and per text the further segmentations:
        ``(score, edits)``, an edit being ``(place, pieces replaced, ids)`` against the best one."""
        prefix = " " if self.v.prefix else ""
        words = [self.v.word.findall(prefix + x) if x else [] for x in texts]
        if self.n_words > MEMORY:
            self._forget()
        self.learn(list(set().union(*words).difference(self.index)))
        per = np.array([len(w) for w in words])
        at = np.fromiter((self.index[x] for w in words for x in w), np.int64, int(per.sum()))
        count = self.count[at]
        total = int(count.sum())
        place = np.cumsum(count) - count
        flat = self.ids[np.repeat(self.begin[at] - place, count) + np.arange(total)]
        sizes, scores, more = [], [], []
        for w, b in zip(words, np.cumsum(per)):
            own = at[b - len(w) : b]
            sizes.append(int(count[b - len(w) : b].sum()))
            scores.append(int(self.score[own].sum()))
            more.append(self._others(w, own, place[b - len(w) : b] - (place[b - len(w)] if len(w) else 0), scores[-1], n) if n > 1 and len(w) else [])
        return flat, np.array(sizes, np.int64), scores, more

    def _others(self, words: list[str], own: np.ndarray, place: np.ndarray, score: int, n: int) -> list[tuple[int, list[tuple[int, int, list[int]]]]]:
        gap = self.gap[own]
        k = min(n - 1, len(gap))
        near = np.flatnonzero(gap <= np.partition(gap, k - 1)[k - 1])
        near = np.sort(near[np.lexsort((-near, gap[near]))][:k])  # only these can deviate in one of the n best
        lists = []
        for i in near:
            key = (words[i], n)
            if key not in self.lists:
                self.lists[key] = n_best(words[i], self.v, n)
            lists.append(self.lists[key])
        heap, out = [(0, (0,) * k, 0)], []
        while heap and len(out) < n:
            lost, ranks, first = heapq.heappop(heap)
            out.append((score - lost, [(int(place[near[j]]), int(self.count[own[near[j]]]), lists[j][r][1]) for j, r in enumerate(ranks) if r]))
            for j in range(first, k):
                if ranks[j] + 1 < len(lists[j]):
                    step = lists[j][ranks[j]][0] - lists[j][ranks[j] + 1][0]
                    heapq.heappush(heap, (lost + step, (*ranks[:j], ranks[j] + 1, *ranks[j + 1 :]), j))
        return out[1:]


def apply_edits(ids: list[int], edits: list[tuple[int, int, list[int]]]) -> list[int]:
    """The ids of a further segmentation."""
    out = list(ids)
    for place, n, new in sorted(edits, reverse=True):
        out[place : place + n] = new
    return out


def decode(ids: list[int] | np.ndarray, v: Vocabulary) -> str:
    """The text of ids: pieces and bytes joined, without the blank that encoding puts in front. Lone surrogates come back as they went in."""
    raw = b"".join(map(v.spelled.__getitem__, ids))
    raw = raw[1:] if v.prefix and raw.startswith(b" ") else raw
    try:
        return raw.decode("utf-8", "surrogatepass")
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace")


SCHEMA = "ids array<int>, piece_score double, alternatives array<struct<score:double, edits:array<struct<place:int, pieces:int, ids:array<int>>>>>, decoded string"


def encode(docs: DataFrame, vocabulary: Vocabulary, n: int = 3, keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns, all by default, so no name clashes) with ``ids`` of the best segmentation, its log score,
    up to ``n - 1`` further ones as edits, and the text decoded from ``ids``.

    Null texts have null in all of them; an empty text has no ids and no alternatives. Whole texts
    are encoded; a task holds ``CHUNK`` texts and ``MEMORY`` words. A text without blanks is one word of any length.
    """
    edit = pa.struct([("place", pa.int32()), ("pieces", pa.int32()), ("ids", pa.list_(pa.int32()))])
    other = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(edit))]))
    names = ["row", "ids", "piece_score", "alternatives", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(vocabulary)
        for batch in batches:
            for a in range(0, batch.num_rows, CHUNK):
                b = batch.slice(a, CHUNK)
                texts = b.column("text").to_pylist()
                null = np.array([x is None for x in texts], bool)
                flat, sizes, score, more = enc.encode([x or "" for x in texts], n)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()), mask=pa.array(null))
                plain = flat.tolist()
                back = [None if z else decode(plain[i:j], vocabulary) for z, i, j in zip(null, ends, ends[1:])]
                alt = [None if z else [{"score": s / UNIT, "edits": [{"place": p, "pieces": k, "ids": x} for p, k, x in e]} for s, e in m] for z, m in zip(null, more)]
                own = pa.array(np.array(score, np.float64) / UNIT, pa.float64(), mask=null)
                yield pa.RecordBatch.from_arrays([b.column("row"), ids, own, pa.array(alt, other), pa.array(back, pa.string())], names)

    src = spread(docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), F.col("text").cast("string").alias("text")))
    return src.mapInArrow(run, StructType([src.schema["row"], *StructType.fromDDL(SCHEMA).fields]))


@query("op1_pieces")
def op1_pieces(t):
    """The three best segmentations of every document, and whether decoding gives its text back."""
    out = encode(t.documents, load(), 3, ["doc_id", "text"])
    return out.select("row.doc_id", F.size("ids").alias("n_pieces"), "ids", "piece_score", "alternatives", F.col("decoded").eqNullSafe(F.col("row.text")).alias("round_trip"))
