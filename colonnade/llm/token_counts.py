"""Token counts of a byte-pair tokenizer by the whole-token shortcut.

Merging depends on a pre-token alone. So it is proved once, on the driver, which strings of the vocabulary come out of
the merges as one token; a pre-token that is one of them counts 1 without being merged, and only the rest is merged.
Special strings are taken out first, as the library does by default.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from colonnade.llm.base import query, spread

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 1024
#: Merged pre-tokens that a task remembers (beyond, it starts over), and the longest of them.
MEMORY, LONGEST = 300_000, 64
#: Pre-tokens of a longer text are counted one by one, not listed first.
LISTED = 1 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is visible, else the next free one from 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    free = iter(range(256, 512))
    return [chr(b if b in visible else next(free)) for b in range(256)]


LETTERS = byte_letters()


def spell(text: str) -> str:
    """A text in the letters of the vocabulary."""
    return "".join(map(LETTERS.__getitem__, text.encode("utf-8", "surrogatepass")))


def whole_tokens(tokenizer: Tokenizer) -> frozenset[str]:
    """The vocabulary strings that the merges turn into one token; a string that is no text on its own can't be a pre-token."""
    back, out = {c: b for b, c in enumerate(LETTERS)}, []
    for piece in tokenizer.get_vocab(with_added_tokens=False):
        if all(c in back for c in piece) and len(tokenizer.model.tokenize(piece)) == 1:
            try:
                out.append(bytes(back[c] for c in piece).decode())
            except UnicodeDecodeError:
                continue
    return frozenset(out)


class Counting:
    """Token counts of texts with one tokenizer file; ``source`` is its content, ``whole`` the proved strings."""

    def __init__(self, source: str, whole: frozenset[str]):
        self.tokenizer, self.whole, self.memory = Tokenizer.from_str(source), whole, {}
        special = self.tokenizer.get_added_tokens_decoder().values()
        kind = type(self.tokenizer.pre_tokenizer).__name__
        if kind != "ByteLevel" or self.tokenizer.normalizer is not None or any(t.lstrip or t.rstrip or t.single_word for t in special):
            raise ValueError("only byte-level files without normalizer and with plain special tokens")
        by_length = sorted((t.content for t in special), key=lambda x: (-len(x), x))
        self.special = regex.compile("|".join(map(regex.escape, by_length))) if by_length else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.agreed: dict[int, bool] = {}

    def _agree(self, block: int) -> bool:
        """Whether the pattern and the library cut alike at each of 256 characters; they may know different versions of Unicode."""
        if block not in self.agreed:
            points = [p for p in range(block << 8, block + 1 << 8) if not 0xD800 <= p < 0xE000]
            probe = "".join(f"a{chr(p)}1{chr(p)}!{chr(p)} " for p in points)
            ends = [e for _, (_, e) in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]
            self.agreed[block] = ends == [m.end() for m in self.pattern.finditer(probe)]
        return self.agreed[block]

    def pre_tokens(self, text: str) -> Counter:
        """How often each pre-token stands in a text without special strings."""
        if text.isascii() or all(map(self._agree, {ord(c) >> 8 for c in set(text)})):
            return Counter(self.pattern.findall(text) if len(text) < LISTED else (m.group() for m in self.pattern.finditer(text)))
        return Counter(text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))

    def merged(self, pre_token: str) -> int:
        """Tokens of a pre-token that is none on its own."""
        n = self.memory.get(pre_token)
        if n is None:
            n = len(self.tokenizer.model.tokenize(spell(pre_token)))
            if len(pre_token) <= LONGEST:
                if len(self.memory) >= MEMORY:
                    self.memory.clear()
                self.memory[pre_token] = n
        return n

    def count(self, text: str) -> tuple[int, int]:
        """Tokens of a text, and how many of them the shortcut counted."""
        direct = rest = 0
        parts = self.special.split(text) if self.special else [text]
        for part in parts:
            for p, c in self.pre_tokens(part).items():
                if p in self.whole:
                    direct += c
                else:
                    rest += c * self.merged(p)
        return direct + rest + len(parts) - 1, direct


def count_tokens(docs: DataFrame, keep: Sequence[str] | None = None, path: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns, all by default, so no name clashes), ``n_bytes``, ``n_tokens``, ``n_whole``
    (tokens that the shortcut counted) and ``over_limit`` for every row of ``docs``.

    A null text is empty and has no tokens; a text of any length is counted whole. The file is read on the driver; it and
    the proved strings, both of the vocabulary's size, are broadcast.
    """
    with open(path, encoding="utf-8") as f:
        source = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((source, whole_tokens(Tokenizer.from_str(source))))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = spread(docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), text.alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting(*shared.value)
        for b in batches:
            size, got = [], []
            for x in b.column("text"):
                size.append(x.as_buffer().size)
                got.append(counting.count(x.as_py()))
            columns = [b.column("row"), pa.array(size, type=pa.int64()), *(pa.array([g[i] for g in got], type=pa.int64()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_bytes", "n_tokens", "n_whole"])

    schema = StructType([src.schema["row"], *(StructField(c, LongType()) for c in ("n_bytes", "n_tokens", "n_whole"))])
    return src.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)


@query("op12_token_counts")
def op12_token_counts(t):
    """Tokens of every document, and whether they are over the limit."""
    return count_tokens(t.documents, ["doc_id"]).select("row.doc_id", "n_bytes", "n_tokens", "over_limit", "n_whole")
