"""The whole corpus pipeline on a small folder of tables with planted cases, stage by stage."""

import random

import corpus_pipeline
import pytest

from colonnade.llm import pieces

BAD = ["idiot", "moron", "stupid", "worthless"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["an", "er", "th", "on", "re", "he", "in", "lo", "ka", "mi"]) for _ in range(rng.randint(2, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    docs, labels, kind = {}, [], {}
    for i in range(400):  # labelled ones to learn from
        w = [word() for _ in range(60)]
        if i % 4 == 0:
            for _ in range(3):
                w[rng.randrange(60)] = rng.choice(BAD)
        docs[i], kind[i] = " ".join(w), "toxic" if i % 4 == 0 else "clean"
        labels.append((i, 1, int(i % 4 == 0)))
    for i in range(1000, 1020):
        docs[i], kind[i] = f"{text(40)} {rng.choice(BAD)} {text(10)} {rng.choice(BAD)}", "toxic"
    shared = text(55)
    for i in range(1100, 1102):  # a passage of over 50 words in exactly two documents
        docs[i], kind[i] = f"{text(30)}\n{shared}\n{text(30)}", "passage"
    base = text(200)
    for i in range(1200, 1212):  # one text and near copies of it, a word changed in each
        w = base.split()
        if i > 1200:
            w[rng.randrange(200)] = word()
        docs[i], kind[i] = " ".join(w), "copy"
    items = [(1, text(14)), (2, text(20))]
    for i in range(1300, 1310):
        docs[i], kind[i] = f"{text(40)}, {items[i % 2][1].upper()}. {text(20)}", "leak"
    docs[1400], kind[1400] = "漢字仮名交じり文 \U0001f600 ▁ own mark " + text(40), "clean"
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", "s", len(t)) for i, t in docs.items()] + [(1500, None, "en", "s", None), (1501, "", None, None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, kind, shared


def test_run(spark, planted):
    path, docs, kind, shared = planted
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    left = {k: [i for i in out if kind.get(i) == k] for k in set(kind.values())}
    clean = [i for i in kind if kind[i] == "clean"]
    assert left["toxic"] == [] and left["leak"] == [] and left["copy"] == [1200] and len(left["clean"]) >= 0.98 * len(clean)
    assert shared in out[1100].text and shared not in out[1101].text and out[1101].n_chars == len(out[1101].text)
    assert all(out[i].text == docs[i] for i in left["clean"]) and all(r.round_trip for r in out.values())
    v = pieces.load()
    assert all(pieces.decode(r.ids, v) == r.text for r in out.values() if r.text is not None) and all(r.n_pieces == len(r.ids) for r in out.values() if r.ids is not None)


def test_stages_keep_the_columns(spark, planted):
    path = planted[0]
    src = spark.read.parquet(f"{path}/documents.parquet")
    docs = src
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "pieces"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == src.columns
    empty = corpus_pipeline.STAGES[-1][1](spark, src.filter("false"), path)
    assert empty.columns[:5] == src.columns and empty.count() == 0
