"""Fill-in-the-middle, token counts and the Merkle manifest against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_llm_operators import docs_of, own_columns, with_clashes
from tokenizers import Tokenizer

from colonnade.llm import fill_in_middle as fim
from colonnade.llm import manifest, token_counts

sha = lambda x: hashlib.sha256(x.encode()).hexdigest()


# --- fill-in-the-middle -------------------------------------------------------------------------------------------------


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digits = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_texts():
    rng = random.Random(1)
    alphabet = ["a", "b", "é", "漢", "\U0001f600", " ", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\u2003", "<", "S", ">"]
    texts = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))) for i in range(600)]
    texts += [(1000 + i, x) for i, x in enumerate([None, "", " ", "\n\n", "x", " x", "x ", "has <P> in it", "has <M>", "<", "w " * 60_000, "é" * 30_000] * 6)]
    return texts + [(None, "no id here"), (None, "no id here"), (5, "twice"), (5, "twice"), (-7, "a negative id")]


def test_fill_in_middle(spark):
    texts = fim_texts()
    docs = with_clashes(docs_of(spark, texts)).withColumns({"form": F.lit("own form"), "output": F.lit("own output")})
    got = fim.fill_in_middle(docs).collect()
    want = [(i, *plain_fim(i, t), sha(t or "")) for i, t in texts]
    assert Counter((r.row.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored_sha256) for r in got) == Counter(want)
    assert all(r.output_sha256 == sha(r.output) and r.row.form == "own form" for r in got) and own_columns(r.row for r in got)
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    assert fim.fill_in_middle(docs.filter("false")).count() == 0


def test_restore_needs_only_output_and_form():
    for i, t in fim_texts():
        n, form, _, _, output = plain_fim(i, t)
        assert fim.restore(output.encode(), form).content().decode() == (t or "")


def test_piece_table():
    table = fim.PieceTable((b"abcdef", b"XY"), [(0, 0, 6), (1, 0, 2)])
    cut = table.cut([0, 2, 2, 6, 7])
    assert [bytes(x) for x in cut] == [b"", b"ab", b"", b"cdef", b"", b"X", b"Y"] and cut.content() == table.content(), "a cut at a border leaves an empty piece"
    order = [6, 0, 3, 1, 5, 2, 4]
    moved = cut.arranged(order)
    assert moved.content() == b"YcdefabX" and moved.restored(order).pieces == cut.pieces and moved.buffers is cut.buffers
    assert moved.digest() == hashlib.sha256(b"YcdefabX").hexdigest()


# --- token counts -------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(token_counts.TOKENIZER)


def token_texts():
    rng = random.Random(2)
    alphabet = [*"aeiou tnsr   \n\t'sdm.,!?0123", "<|endoftext|>", "<|", "|>", "é", "ß", "漢", "\u3000", "\U00010940", "\u088f", "\U0001f600", "\u200d", "'ll", " '", "\x1c", "\x85", " the", "ing"]
    texts = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for i in range(1500)]
    return texts + [(2000, None), (2001, ""), (2002, "a" * 100_000), (2003, "the " * 50_000), (2004, " " * 30_000), (2005, "<|endoftext|>" * 3), (None, "no id"), (3, "twice"), (3, "twice")]


def test_token_counts(spark, tokenizer):
    texts = token_texts()
    docs = with_clashes(docs_of(spark, texts)).withColumn("n_tokens", F.lit("own"))
    got = token_counts.count_tokens(docs).collect()
    count = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    assert Counter((r.row.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == Counter((i, len((t or "").encode()), count(t), count(t) > 1024) for i, t in texts)
    assert own_columns(r.row for r in got) and all(r.row.n_tokens == "own" and r.n_whole <= r.n_tokens for r in got)
    by = {r.row.doc_id: r for r in got}
    assert by[2003].n_whole >= 49_999 and by[2005].n_tokens == 3
    assert token_counts.count_tokens(docs.filter("false")).count() == 0


def test_whole_tokens_are_proved(tokenizer):
    whole = token_counts.whole_tokens(tokenizer)
    assert 45_000 < len(whole) <= tokenizer.get_vocab_size() and " the" in whole
    for t in random.Random(3).sample(sorted(whole), 3000):
        assert len(tokenizer.model.tokenize(token_counts.spell(t))) == 1
    assert token_counts.spell(" é") == tokenizer.pre_tokenizer.pre_tokenize_str(" é")[0][0]


def test_counting_forgets_within_its_bound(tokenizer, monkeypatch):
    monkeypatch.setattr(token_counts, "MEMORY", 5)
    monkeypatch.setattr(token_counts, "LISTED", 20)
    counting = token_counts.Counting(tokenizer.to_str(), token_counts.whole_tokens(tokenizer))
    for _, t in token_texts()[:300]:
        assert counting.count(t)[0] == len(tokenizer.encode(t, add_special_tokens=False).ids) and len(counting.memory) <= 5


# --- Merkle manifest ----------------------------------------------------------------------------------------------------


def plain_leaf(row, lower=False):
    values = [row[c] for c in manifest.LEAF]
    if lower and values[-1] is not None:
        values[-1] = "".join(c.lower() if "A" <= c <= "Z" else c for c in values[-1])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """The last node, and for every node its segments (left, right) up to it."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_owners = [], []
        for a in range(0, len(nodes), 8):
            run = nodes[a : a + 8]
            for j in range(len(run)):
                for i in owners[a + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha("".join(run)))
            up_owners.append([i for o in owners[a : a + 8] for i in o])
        nodes, owners = up, up_owners
    return nodes[0], paths


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in names:
        groups[k].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        trees[k] = plain_tree([plain_leaf(r) for r in groups[k]])
    root, upper = plain_tree([trees[k][0] for k in names])
    out = []
    for k, top in zip(names, upper):
        for r, own in zip(groups[k], trees[k][1]):
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            node = plain_leaf(r, tampered)
            for left, right in own + top:
                node = sha(left + node + right)
            out.append((r["doc_id"], plain_leaf(r), trees[k][0], root, sha("".join(a + b for a, b in own + top)), node, node == root))
    return out


def merkle_rows(n, seed=1):
    rng = random.Random(seed)
    langs = [None, "", "en", "en", "en", "de", "zz", "Ä", "\U0001f600", "=", "\uffff"]
    return [(i, rng.choice([None, "", "Mixed Case ÄÖ", "lower", "x" * 5000]), rng.choice(langs), rng.choice([None, "s"]), rng.choice([None, 5])) for i in range(n)]


@pytest.mark.parametrize("rows", [merkle_rows(700), merkle_rows(1), [(1, "A", "en", "s", 1), (1, "A", "en", "s", 1), (1, "B", "en", "s", 1), (None, "C", "en", None, None), (None, "C", "en", None, None)], [(i, "T", "en", "s", 1) for i in range(9)], [(i, "T", f"l{i:03d}", "s", 1) for i in range(70)]])
def test_manifest(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    clashing = docs.withColumns({c: F.lit("own") for c in ("k", "at", "n", "digest", "leaf", "kids", "run", "segments", "_slice", "_seq", "root")})
    got = manifest.manifest_proofs(clashing).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain_manifest([r.asDict() for r in docs.collect()]))


def test_manifest_without_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert manifest.manifest_proofs(docs).collect() == []


def test_requested_leaves_only(spark):
    docs = spark.createDataFrame(merkle_rows(300, 2), "doc_id long, text string, lang string, source string, n_chars long")
    built = manifest.build(manifest.document_leaves(docs))
    every = {(r.doc.i, r.leaf): r for r in manifest.proofs(built).collect()}
    asked = spark.createDataFrame([("en", 0), ("en", 13), ("en", 40), (None, 2), ("none such", 1), ("en", 100_000)], "lang string, at long")
    some = manifest.proofs(built, asked).collect()
    assert sorted(r.doc.i for r in some) == [0, 2, 13, 40] and all(every[r.doc.i, r.leaf].path == r.path for r in some)
    top = built.groups.levels[-1].first()
    assert manifest.DIGITS * 2 <= len(top.kids) and hashlib.sha256(top.kids.encode()).hexdigest() == top.digest, "records are stored under the digest of their children"
