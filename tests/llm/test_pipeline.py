"""The stages on a small corpus with awkward rows, each against what it must do."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.decontamination import found_by_hand
from tidemark.llm.near_dedup import near_duplicates_by_hand
from tidemark.llm.packing import default_vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    say = lambda n, size=400: " ".join(f"w{rng.randrange(size)}" for _ in range(n))
    item = "the quick benchmark item that nobody should ever train on because it measures something we care about a lot"
    rows, labels = [], []
    common = "this footer line stands in very many of these documents"
    for k in range(160):
        text = say(60)
        if k % 8 == 0:
            text = " ".join(f"{w}!!" for w in text.split())
        if k % 5 == 1:
            text += "\n" + common
        if k in (51, 93):
            text = f"{say(20)} {item} {say(20)}"
        rows.append((k, text, "en", f"s{k % 4}", len(text)))
        if k % 2 == 0:
            labels.append((k, int(k % 8 != 0), 0))
    base = say(80)
    for k in range(160, 166):
        text = base.replace(base.split()[5], f"x{k}", 1)
        rows.append((k, text, "en", "s1", len(text)))
    rows += [(166, None, None, None, None), (167, "", "en", "s1", 0), (None, say(30), "en", "s1", 5), (168, rows[3][1], "en", "s2", 9), (168, rows[3][1], "en", "s2", 9)]
    rows.append((169, say(20_000, 5000), "en", "s3", 1))
    out = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(0, item), (1, None), (2, "")], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def documents(spark, folder):
    extra = {c: F.lit(1) for c in ("n_lines", "kept_text", "_lost", "_row", "score", "kept", "id", "_held", "_all", "h1")}
    return spark.read.parquet(f"{folder}/documents.parquet").withColumns(extra)


def test_stages_keep_columns(spark, folder):
    docs = documents(spark, folder)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert out.count() <= docs.count()
        assert {r[c] for r in out.select("n_lines", "kept_text", "score").collect() for c in range(3)} == {1}
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_quality_stage(spark, folder):
    docs = documents(spark, folder)
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, folder).collect()}
    bad = {k for k in range(0, 160, 8)}
    assert len(kept & bad) <= 1 and len({k for k in range(160) if k % 8} - kept) <= 8


def test_line_stage(spark, folder):
    out = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, documents(spark, folder), folder).collect()}
    holders = [k for k, t in out.items() if t and "footer line" in t]
    assert len(holders) == 1 and holders[0] == max(k for k in range(160) if k % 5 == 1 and k not in (51, 93))
    assert out[166] is None and out[167] == ""


def test_near_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = [r.doc_id for r in corpus_pipeline.near_copies(spark, docs, folder).collect()]
    want = near_duplicates_by_hand([(r.doc_id, r.text) for r in docs.filter("doc_id IS NOT NULL").collect()], size=5)
    assert sorted(k for k in left if k is not None) == sorted(k for k, v in want.items() if v[2]) and left.count(None) == 1
    assert 160 in left and not {161, 162, 163, 164, 165, 168} & set(left)


def test_decontamination_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {r.doc_id for r in corpus_pipeline.decontaminated(spark, docs, folder).collect()}
    rows = docs.collect()
    assert {r.doc_id for r in rows} - left == {51, 93}
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for r in rows[::3] + [r for r in rows if r.doc_id in (51, 93)]:
        if len(r.text or "") < 2000:
            assert any(found_by_hand(r.text, i) for i in items) == (r.doc_id in (51, 93))


def test_run(spark, folder):
    from tokenizers import Tokenizer

    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and all(r.length <= 4096 for r in rows)
    spans = {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in spans.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))] and sum(n for _, n in pieces) <= 4096
    assert not {51, 93, 161, 165} & {r.doc_id for r in rows}
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    n = len(Tokenizer.from_file(default_vocabulary()).encode(text[169], add_special_tokens=False).ids) + 1
    assert sum(r.length for r in rows if r.doc_id == 169) == n
