"""Values that the operators must give, and invariances."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import stats
from tidemark.functions import text as T
from tidemark.operators import chunking, evaluation, experiments, fusion, graph, matching, output, sampling, search
from tidemark.sources import readers, sinks
from tidemark.streaming.incremental import take_in


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("v")).first()["v"]


def ranking(spark, lists):
    """lists: encoder -> [(chunk, sim)]"""
    rows = [(1, e, o, r, c, s) for o, (e, l) in enumerate(lists.items(), 1) for r, (c, s) in enumerate(l, 1)]
    return spark.createDataFrame(rows, "query_id long, encoder string, enc_ord int, rank int, chunk_id long, sim double")


def order(df):
    return [r.chunk_id for r in df.orderBy("pos").collect()]


def test_fusion_scores(spark):
    r = ranking(spark, {"a": [(1, 0.9), (2, 0.8)], "b": [(2, 0.7), (3, 0.1)]})
    score = lambda mode, **k: {x.chunk_id: x.score for x in fusion.fuse(r, mode, **k).collect()}
    assert score("rrf")[2] == pytest.approx(1 / 62 + 1 / 61)
    assert score("combsum") == {1: 0.9, 2: 1.5, 3: 0.1}
    assert score("combmnz") == {1: 0.9, 2: 3.0, 3: 0.1}
    assert score("convex") == {1: 1.0, 2: 1.0, 3: 0.0}
    assert score("convex", weights={"b": 0.5})[2] == 0.5
    with pytest.raises(ValueError):
        fusion.fuse(r, "other")


def test_equal_scores_keep_first_appearance(spark):
    r = ranking(spark, {"a": [(7, 0.5), (9, 0.5)], "b": [(9, 0.5), (7, 0.5)]})
    assert order(fusion.fuse(r, "rrf")) == [7, 9]
    constant = ranking(spark, {"a": [(5, 0.3), (4, 0.3)]})
    assert {x.score for x in fusion.fuse(constant, "convex").collect()} == {1.0}


def test_threshold(spark):
    r = ranking(spark, {"a": [(1, 1.0), (2, 0.9), (3, 0.89)], "b": [(4, -0.1), (5, -0.5)]})
    assert {x.chunk_id for x in fusion.threshold(r, 0.9).collect()} == {1, 2, 4, 5}
    assert fusion.threshold(r, None).count() == fusion.threshold(r, 0).count() == 5


def candidates(spark, rows):
    return spark.createDataFrame(rows, "query_id long, chunk_id long, doc_id long, fuente string, fenomeno long, query_fenomeno long, texto string, score double, pos int")


def test_boost_dedup_diversify_pool(spark):
    rows = [
        (1, 10, 1, "s", 1, 2, "Uno  dos", 1.0, 1), (1, 11, 1, "s", 2, 2, "uno dos", 0.99, 2), (1, 12, 1, "", 1, 2, "tres", 0.9, 3), (1, 13, 2, "t", None, 2, "cuatro", 0.8, 4),
    ]
    c = candidates(spark, rows)
    assert order(fusion.boost(c)) == [11, 10, 12, 13]
    assert order(fusion.boost(c, 1.0)) == [10, 11, 12, 13]
    assert order(fusion.distinct_texts(c)) == [10, 12, 13]
    assert order(fusion.diversify(c, 3, 1)) == [10, 13, 11]
    docs = {m: [(r.doc_id, r.fuente) for r in fusion.pool_documents(c, 3, m).orderBy("rank").collect()] for m in ("max", "suma", "media", "top2", "odd")}
    assert docs["suma"][0] == (1, "s") and docs["odd"] == docs["max"]
    assert (1, "1") in docs["max"]  # an empty source falls back to the document
    with pytest.raises(ValueError):
        fusion.pool_documents(c, 3, "suma", strict=True)


def test_search_and_feedback(spark):
    index = spark.createDataFrame([(1, [1.0, 0.3, 0.0]), (2, [0.98, 0.0, 0.199]), (3, [0.0, 1.0, 0.0])], "chunk_id long, vector array<double>")
    index = index.withColumn("vector", search.unit(F.col("vector")))
    q = spark.createDataFrame([(1, [1.0, 1.0, 0.0])], "query_id long, vector array<double>")
    found = search.top_k(index, q, 3)
    got = [r.chunk_id for r in found.orderBy("rank").collect()]
    assert got == [1, 3, 2]
    again = search.top_k(index, search.feedback(q, index, found, 1, beta=0.9), 3)
    assert [r.chunk_id for r in again.orderBy("rank").collect()] == [1, 2, 3]
    assert search.feedback(q, index, found, 1, beta=0.0).first().vector == [1.0, 1.0, 0.0]
    with pytest.raises(Exception):
        search.check_dimension(index, 4).collect()


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_search_does_not_depend_on_partitions(spark, parts):
    rng = random.Random(1)
    rows = [(k, [rng.random() for _ in range(4)]) for k in range(60)]
    index = spark.createDataFrame(rows, "chunk_id long, vector array<double>").repartition(parts)
    q = spark.createDataFrame([(k, v) for k, v in rows[:5]], "query_id long, vector array<double>")
    got = {(r.query_id, r.rank): r.chunk_id for r in search.top_k(index, q, 4).collect()}
    for k, v in rows[:5]:
        best = sorted(rows, key=lambda r: (-round(sum(a * b for a, b in zip(r[1], v)), config.TAU_DIGITS), r[0]))[:4]
        assert [got[k, i] for i in range(1, 5)] == [b[0] for b in best]


def test_shares_of_blocks(spark):
    rows = search.with_block(spark.range(5000), "id", 2048)
    assert {(r.block, r["count"]) for r in rows.groupBy("block").count().collect()} == {(0, 2048), (1, 2048), (2, 904)}
    parts = [search.blocks_of_share(rows, 3, a, b) for a, b in ((0, 34), (34, 67), (67, 100))]
    assert sorted(r.id for p in parts for r in p.collect()) == list(range(5000))
    for bad in ((50, 50), (-1, 5), (5, 101)):
        with pytest.raises(ValueError):
            search.share(*bad)


def test_f1_and_ndcg(spark):
    def f1(got, want):
        docs = spark.createDataFrame([(1, k, d) for k, d in enumerate(got, 1)], "query_id long, rank int, fuente string")
        return evaluation.f1(docs, spark.createDataFrame([(1, w) for w in want], "query_id long, fuente string")).first().f1

    assert f1("abc", "abc") == 1
    assert f1("axy", "a") == pytest.approx(0.5)
    assert f1("abc", "abcde") == 1
    assert f1("aaa", "ab") == pytest.approx(0.4)
    results = spark.createDataFrame([(1, 1, "c1"), (2, 1, "cx")], "query_id long, rank int, chunk_id string")
    qrels = spark.createDataFrame([(1, "c1", 2.0), (2, "c9", 2.0)], "query_id long, chunk_id string, grade double")
    assert {r.query_id: r.ndcg for r in evaluation.ndcg(results, qrels).collect()} == {1: 1.0, 2: 0.0}


def test_kappa_edges(spark):
    k = lambda rows: [r.kappa for r in evaluation.kappa(spark.createDataFrame(rows, "a int, b int")).collect()]
    assert k([(1, 1), (1, 1)]) == [1.0] and k([]) == []


def test_wilcoxon():
    assert stats.wilcoxon([1, 2, 3, 4, 5.5], [0] * 5)[1] == pytest.approx(2 / 32)
    assert stats.wilcoxon([1.0] * 20, [0.5] * 20)[1] < 0.001
    assert stats.wilcoxon([1.0, 2.0], [1.0, 2.0]) == (0.0, 1.0)
    counts = stats.rank_sum_counts(4)
    assert counts == [sum(sum(s) == k for n in range(5) for s in itertools.combinations((1, 2, 3, 4), n)) for k in range(11)]
    with pytest.raises(ValueError):
        stats.wilcoxon([1], [])


def test_permutation_and_bootstrap():
    assert stats.permutation([1.0] * 20, [0.0] * 20, 20_000)[1] < 0.001
    assert stats.permutation([1.0] + [0.0] * 19, [0.0] * 20, 5_000)[1] > 0.5
    low, high = stats.bootstrap([0.2, 0.4, 0.6, 0.8])
    assert low <= 0.5 <= high and stats.bootstrap([0.3] * 5) == pytest.approx((0.3, 0.3)) and stats.bootstrap([]) == (0.0, 0.0)


def test_paired_in_spark(spark):
    run = spark.createDataFrame([(k, 0.5 + k / 100, 0.5) for k in range(8)], "query_id long, ndcg double, f1 double")
    base = spark.createDataFrame([(k, 0.5, 0.5) for k in range(3, 12)], "query_id long, ndcg double, f1 double")
    out = {r.metric: r for r in stats.paired(run, base).collect()}
    assert out["ndcg"].p_wilcoxon == pytest.approx(2 / 32, abs=1e-4) and out["f1"].p_wilcoxon == 1.0
    assert stats.paired(run, base.filter("query_id > 100")).count() == 0


def test_text_functions(spark):
    v = lambda c, **k: one(spark, c, **k)
    assert v(T.normalise(F.col("t")), t="ﬁn\r\n\r\r\n\n a  b \x07ć") == "fin\n\na b ć"
    assert v(T.drop_numbering(F.col("t")), t="12 - 3\ntexto 1\n\n***") == "texto 1\n"
    assert v(T.name_key(F.lit("la Unión Europea"))) == "union europea"
    assert v(T.name_key(F.lit("EE. UU."))) == "ee uu"
    assert v(T.name_key(F.lit("a NASA"))) == "nasa"
    assert v(T.phenomenon_of(F.lit("q017"))) == 2 and v(T.phenomenon_of(F.lit("q051"))) is None
    assert v(T.chunking_key(F.lit(504), F.lit(0.15))) == "c504-s015"
    assert v(T.truncate_words(F.lit("uno dos. tres cuatro cinco."), 3)) == "uno dos."
    assert v(T.truncate_words(F.lit("uno dos tres cuatro"), 3)) == "uno dos tres"
    assert v(T.language(F.lit("the of and to in " * 5))) == "en" and v(T.language(F.lit("hola"))) == "xx"
    assert v(T.language(F.lit("que de não são em dos " * 5))) == "pt"
    assert v(T.row_text(["a", "b"]), a="x", b=" ") == "a: x"
    assert v(T.evidence(F.lit("x" * 300))) == "x" * 239 + "…"


def greedy(units, budget, overlap):
    """What pack() must give: chunks as (text, tokens)."""
    carry, out, cur, n = int(budget * overlap), [], [], 0
    for u in units:
        k = len(u.split())
        if k > budget:
            out += [(" ".join(cur), n)] if cur else []
            w, size = u.split(), budget - 2
            out += [(" ".join(w[i : i + size]), len(w[i : i + size])) for i in range(0, k, size)]
            cur, n = [], 0
            continue
        if cur and n + k > budget:
            out.append((" ".join(cur), n))
            tail = []
            for x in cur[::-1]:
                if sum(len(y.split()) for y in tail) + len(x.split()) > carry:
                    break
                tail.insert(0, x)
            cur, n = tail, sum(len(y.split()) for y in tail)
        cur, n = [*cur, u], n + k
    return [*out, (" ".join(cur), n)] if cur else out


@pytest.mark.parametrize("overlap", [0.0, 0.15, 0.5])
def test_pack(spark, overlap):
    rng = random.Random(7)
    lists = [[" ".join("w" * rng.randrange(1, 4) for _ in range(rng.choice([1, 3, 8, 30]))) for _ in range(rng.randrange(0, 30))] for _ in range(40)]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k long, u array<string>")
    for r in df.select("k", chunking.pack(F.col("u"), 20, overlap).alias("c")).collect():
        assert [(c.texto, c.tokens) for c in r.c] == greedy(lists[r.k], 20, overlap)


def test_chunks(spark):
    text = " ".join(f"palabra{k} sigue aquí." for k in range(60)) + " " + "larga " * 90
    docs = spark.createDataFrame([(1, "txt", text), (2, "csv", "a b c d e f g h i j k.\n" * 50), (3, "txt", "corta")], "doc_id long, formato string, texto string")
    rows = chunking.chunk(docs, budget=30, tabular=3).orderBy("doc_id", "posicion").collect()
    assert [r.posicion for r in rows if r.doc_id == 2] == [0, 1, 2]
    assert not [r for r in rows if r.doc_id == 3] and all(r.num_tokens <= 30 for r in rows)
    assert rows[0].chunk_id == "1-chunk-0000"


def test_sections(spark):
    s = "array<struct<titulo: string, texto: string>>"
    df = spark.createDataFrame([([("a", "Uno. sin cierre"), ("b", "dos."), ("c", "Tres. cola")],)], f"s {s}")
    got = df.select(chunking.align_sections(F.col("s")).alias("v")).first().v
    assert [(x.titulo, x.texto) for x in got] == [("a", "Uno."), ("b", "sin cierre dos."), ("c", "Tres. cola")]
    merged = df.select(chunking.merge_sections(F.col("s"), 4).alias("v")).first().v
    assert [(x.titulo, x.tokens) for x in merged] == [("a", 6)]


def test_pieces_and_output(spark):
    long = " ".join(["una frase de cinco palabras."] * 4)
    assert one(spark, output.pieces(F.lit(long), 10)) == [" ".join(["una frase de cinco palabras."] * 2)] * 2
    assert one(spark, output.pieces(F.lit("w " * 25), 10)) == ["w " * 9 + "w", "w " * 9 + "w", "w w w w w"]
    c = candidates(spark, [(1, k, k // 4, "s", 1, 1, f"texto {k}", 1.0, k + 1) for k in range(5)])
    frags = output.emit_fragments(c, per_doc=3)
    assert [r.chunk_id for r in frags.orderBy("rank").collect()] == [0, 1, 2, 4, 3]
    docs = spark.createDataFrame([(1, 1, 7)], "query_id long, rank int, doc_id long")
    rec = output.records(frags, docs)
    r = rec.first()
    assert [d.doc_id for d in r.documents] == [7, 7, 7] and len(r.fragments) == 10 and r.fragments[9].chunk_id == 3
    assert output.problems(rec, 1).count() == 0
    assert {x.problem for x in output.problems(rec.unionByName(rec), 1).collect()} == {"query_id repeated", "wrong number of records"}


def test_matching(spark):
    frase = "la gobernanza de los sistemas autónomos exige reglas comunes y verificables"
    texts = spark.createDataFrame([(1, "x", f"Antes. {frase.upper()}. Después viene otra cosa."), (1, "y", "nada que ver con eso de ahí"), (1, "z", "")], "query_id long, chunk_id string, texto string")
    judged = spark.createDataFrame([(1, 1, 2.0, frase), (1, 2, 1.0, frase), (1, 3, 2.0, None)], "query_id long, judged_id long, grade double, texto string")
    assert {r.chunk_id: r.grade for r in matching.grades(texts, judged, "chunk_id").collect()} == {"x": 2.0, "y": 0.0, "z": 0.0}


def test_graph(spark):
    text = "La ONU regula el uso. Estados Unidos fue financiado por Banco Mundial."
    chunks = spark.createDataFrame([(1, 1, text), (2, 2, "Estados Unidos y la ONU."), (3, 3, "x" * 2500)], "chunk_id long, doc_id long, texto string")
    found = graph.mentions(chunks)
    assert {(r.texto, r.inicio) for r in found.filter("chunk_id = 1").collect()} == {("La ONU", 0), ("Estados Unidos", 22), ("Banco Mundial", 56)}
    entities, ids = graph.canonical(found)
    names = {r.id: r.df for r in entities.collect()}
    assert names["estados unidos"] == 2 and names["onu"] == 2
    t = graph.triples(found, graph.sentence_spans(chunks), chunks, ids).collect()
    assert [(r.sujeto, r.tipo, r.objeto) for r in t] == [("banco mundial", "financia", "estados unidos")]
    nodes, edges = graph.build(found, graph.admitted(entities, 3), ids, graph.triples(found, graph.sentence_spans(chunks), chunks, ids))
    assert {r.clase: r.n for r in graph.summary(nodes, edges).collect()}["nodo entidad"] == 2
    assert "".join(graph.graphml(nodes, edges)).count("<node") == nodes.count()
    assert graph.not_scalar(entities) == ["alias: array<string>"]
    assert one(spark, graph.locate(F.lit("uno dos"), F.lit("dos"), F.lit(0), F.lit(3)))["inicio"] == 4
    assert one(spark, graph.locate(F.lit("uno dos"), F.lit("tres"), F.lit(0), F.lit(3))) is None
    for bad, error in (("gliner2", RuntimeError), ("otro", ValueError)):
        with pytest.raises(error):
            graph.recogniser(bad)


def test_experiments(spark):
    assert [len(s) for s in experiments.subsets(["a", "b", "c"], 2)] == [1, 1, 1, 2, 2, 2]
    assert experiments.select("barato,entrega") == ["entrega", "barato"] and len(experiments.select("todas")) == 10
    with pytest.raises(ValueError):
        experiments.select("nada")
    good, bad = experiments.measurable(list(experiments.RECIPES), 504, 0.15, {"a", "b"})
    assert good == ["entrega", "dos-encoders", "convexa", "filtrado"] and len(bad) == 6
    assert experiments.RECIPES["contexto"].problems({"a": 512}) == ["a holds 512 tokens"]
    assert experiments.parse_list("1, 2", "entero") == [1, 2] and experiments.parse_list("0.9,no", "umbral") == [0.9, None]
    assert experiments.stage_plan(["a"], since="empaquetar") == ["empaquetar", "verificar"]


def test_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("niño".encode("latin-1"))
    (tmp_path / "b.json").write_text('{"title": "T", "content": ["x", null, "y"], "texto": "z"}')
    (tmp_path / "c.json").write_text("{mal")
    (tmp_path / "d.pdf").write_bytes(b"%PDF")
    raw = spark.read.format("binaryFile").load(str(tmp_path)).select(F.element_at(F.split("path", "/"), -1).alias("fuente"), "content")
    got = {r.fuente: r for r in readers.dispatch(raw).collect()}
    assert got["a.txt"].texto == "niño" and got["a.txt"].necesita_ocr
    assert got["b.json"].texto == "T\n\nx\ny"
    assert got["c.json"].error == "invalid json" and got["d.pdf"].error == "no reader for pdf"
    done = {r.fuente: r for r in readers.extract_with(raw, lambda b: b.decode()).collect()}
    assert done["a.txt"].error and done["d.pdf"].texto == "%PDF"
    assert readers.flatten_value({"k": [1, {"z": None}], "l": "x" * 200}) == "k: 1\n" + "x" * 200
    lines = spark.createDataFrame(list(enumerate(["ruido", "Q001. Primera", "sigue", "", "q002", "Q003: tercera   cosa"])), "n long, linea string")
    assert {(r.query_id, r.texto) for r in readers.queries_of_text(lines).collect()} == {("q001", "Primera sigue"), ("q003", "tercera cosa")}
    with pytest.raises(ValueError):
        readers.require(["z"], ["a"])
    with pytest.raises(readers.NotHere):
        readers.binary_reader("pdf")
    with pytest.raises(ValueError):
        readers.load_index(spark.range(3).withColumnRenamed("id", "pos"), spark.range(2).withColumnRenamed("id", "pos"))


def test_catalogue_needs_codes(spark):
    inv = spark.createDataFrame([(1, 1, "O", "a.PDF"), (2, 1, "O", "b.pdf")], "fila long, fenomeno int, observatorio string, fuente string")
    codes = spark.createDataFrame([("O", "ALE")], "observatorio string, codigo string")
    assert [r.doc_id for r in readers.catalogue(inv, codes).orderBy("fila").collect()] == ["F1-ALE-001", "F1-ALE-002"]
    with pytest.raises(Exception):
        readers.catalogue(inv, codes.withColumn("codigo", F.lit("=X"))).collect()


def test_sampling_latest(spark):
    pool = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "query_id long, chunk_id long")
    judged = spark.createDataFrame([(1, 1, 2.0, False, 1), (1, 1, 0.0, True, 2), (1, 9, 2.0, False, 3), (1, 2, 2.0, False, 4)], "query_id long, chunk_id long, grade double, doc boolean, ord int")
    grades, docs, left = sampling.consolidate_latest(pool, judged)
    assert {(r.chunk_id, r.grade) for r in grades.collect()} == {(1, 0.0), (2, 2.0)}
    assert {r.chunk_id for r in docs.collect()} == {1, 2} and {r.chunk_id for r in left.collect()} == {3}


def test_sinks(spark, tmp_path):
    q = spark.createDataFrame([(1, 5, 2.0)], "query_id long, chunk_id long, grade double")
    sinks.write_records(q, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 1
    assert math.isclose(sinks.ground_truth(q, q.withColumnRenamed("chunk_id", "doc_id")).first().fragmentos[5], 2.0)
    sinks.write_index(q.withColumn("encoder", F.lit("a")), str(tmp_path / "i"))
    assert (tmp_path / "i" / "encoder=a").exists()


def test_load_queries(spark, tmp_path):
    (tmp_path / "q.txt").write_text("Q002 dos\r\nsigue\nq001: uno")
    (tmp_path / "q.jsonl").write_text('{"query_id": "Q1", "texto": "", "pregunta": "x"}\n{"query_id": "Q2"}')
    assert [(r.query_id, r.texto) for r in readers.load_queries(spark, str(tmp_path / "q.txt")).collect()] == [("q001", "uno"), ("q002", "dos sigue")]
    rows = spark.createDataFrame([("Q1", "", "x"), ("Q2", None, None)], "query_id string, texto string, pregunta string")
    assert [(r.query_id, r.texto) for r in readers.queries_of_json(rows).collect()] == [("q1", "x")]
    assert readers.load_queries(spark, str(tmp_path / "q.jsonl")).first().texto == "x"
    with pytest.raises(readers.NotHere):
        readers.load_queries(spark, "q.pdf")


def test_csv_and_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,\n")
    assert sorted(r.texto for r in readers.csv_blocks(spark, str(tmp_path / "t.csv")).collect()) == ["a: 1 | b: x", "a: 2"]
    (tmp_path / "n.txt").write_bytes(b"\xef\xbb\xbfhola")
    assert readers.plain_text(spark, str(tmp_path / "n.txt")).first().texto == "hola"
    assert readers.image_document(spark.range(1)).first().necesita_ocr


def test_recover_stops_at_unknown_documents(spark):
    d = lambda *ids: spark.createDataFrame([(i, f"f{i}") for i in ids], "doc_id long, fuente string")
    assert {(r.doc_id, r.fuente, r.indexado) for r in readers.recover(d(1, 2), d(1), d(2)).collect()} == {(1, "f1", True), (2, "f2", False)}
    with pytest.raises(Exception):
        readers.recover(d(1, 2, 3), d(1), d(2)).collect()


def test_chunks_of_sections(spark):
    s = "array<struct<titulo: string, texto: string>>"
    long = " ".join(f"frase número {k}." for k in range(60))
    df = spark.createDataFrame([(1, "pdf", "", [("uno", "corta. " * 40), ("dos", long)]), (2, "pdf", "a b c d e f g h i j k l.", None)], f"doc_id long, formato string, texto string, secciones {s}")
    rows = chunking.chunk_sections(df, budget=50, whole=100).orderBy("doc_id", "posicion").collect()
    assert {r.titulo for r in rows if r.doc_id == 1} == {"uno"} or rows[0].titulo == "uno"
    assert [r.posicion for r in rows if r.doc_id == 1] == list(range(len(rows) - 1)) and rows[-1].titulo is None


def test_take_in(spark, tmp_path):
    src, dst, state = (str(tmp_path / x) for x in ("src", "dst", "state"))
    for k in range(2):
        spark.range(3 * k, 3 * k + 3).coalesce(1).write.mode("append").parquet(src)
        take_in(spark, src, "id long", lambda df: df.withColumn("twice", F.col("id") * 2), dst, state)
    assert sorted(r.twice for r in spark.read.parquet(dst).collect()) == [0, 2, 4, 6, 8, 10]


def test_entry_has_names_and_sql():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_csv_with_quotes_and_encodings(spark, tmp_path):
    from tidemark.sources import readers

    (tmp_path / "u.csv").write_bytes("\ufeffa,b\n1,\"x\ny\"\n,\n2, ñ \n".encode())
    (tmp_path / "l.csv").write_bytes("a,b\n1,año\n".encode("latin-1"))
    assert sorted(r.texto for r in readers.csv_blocks(spark, str(tmp_path / "u.csv")).collect()) == ["a: 1 | b: x\ny", "a: 2 | b:  ñ "]
    raw = spark.createDataFrame([(p.name, p.read_bytes()) for p in tmp_path.iterdir()], "fuente string, content binary")
    got = {r.fuente: r.texto for r in readers.dispatch(raw).collect()}
    assert got == {"u.csv": "a: 1 | b: x\ny\n\na: 2 | b:  ñ ", "l.csv": "a: 1 | b: año"}


def test_preflights():
    from tidemark.operators import experiments
    from tidemark.sources import readers

    assert readers.ocr_available(["spa"], "no-such-command") == (False, "no-such-command isn't installed")
    assert experiments.pick_backend({"cuda": False, "directml": True})[0] == "directml" and experiments.pick_backend({})[0] == "cpu"


def test_export_graphml(spark, tmp_path):
    import xml.etree.ElementTree as ET

    from tidemark.operators import graph

    nodes = spark.createDataFrame([("E:a", "entidad", "A & B"), ("C:1", "fragmento", None)], "id string, kind string, nombre string")
    edges = spark.createDataFrame([("C:1", "E:a", "MENCIONA", None, 2)], "src string, dst string, kind string, tipo string, n int")
    root = ET.parse(graph.export_graphml(nodes, edges, str(tmp_path / "g.graphml"))).getroot()
    assert [n.get("nombre") for n in root.iter("node")] == ["A & B", ""] and len(list(root.iter("edge"))) == 1
    with pytest.raises(ValueError):
        graph.export_graphml(nodes.withColumn("x", F.array()), edges, str(tmp_path / "h.graphml"))


def test_sentences_by_language(spark):
    from tidemark.functions import text as X

    said = [("es", "El Dr. Paz vio el art. 5 de la ley. Luego salió.", 2), ("en", "Mr. J. Smith paid 3.5 M. It was e.g. fine. Done!", 2), ("pt", "A Sra. Lima veio. Fim.", 2), ("xx", "One. Two.", 2)]
    df = spark.createDataFrame(said, "lang string, t string, n int")
    for r in df.select("n", X.sentences(F.col("t"), F.col("lang")).alias("s"), "t").collect():
        assert len(r.s) == r.n and " ".join(r.s) == r.t


def test_pack_with_tokens(spark):
    from tidemark.operators import chunking

    letters = lambda: lambda texts: [len(t.replace(" ", "")) for t in texts]
    df = spark.createDataFrame([(["aa bb", "cccc", "dddddd; eeeeee", "f"],), (None,), ([],)], "u array<string>")
    got = [None if r.c is None else [(x.texto, x.tokens) for x in r.c] for r in df.select(chunking.pack(F.col("u"), 8, 0.0, tokens=letters).alias("c")).collect()]
    assert got == [[("aa bb cccc", 8), ("dddddd;", 7), ("eeeeee", 6), ("f", 1)], None, []]
    long = spark.createDataFrame([([" ".join(["word"] * 20_000)] * 3,)], "u array<string>")
    assert long.select(F.size(chunking.pack(F.col("u"), 500))).first()[0] == 3 * 41


def test_intervals_and_unanswered_queries(spark):
    from tidemark.functions import stats
    from tidemark.operators import evaluation

    frags = spark.createDataFrame([(1, 10, 1), (2, 30, 1)], "query_id int, chunk_id int, rank int")
    docs = spark.createDataFrame([(1, "a", 1), (3, "b", 1)], "query_id int, fuente string, rank int")
    qrels = spark.createDataFrame([(1, 10, 2.0), (2, 20, 1.0), (3, 40, 1.0)], "query_id int, chunk_id int, grade double")
    rel = spark.createDataFrame([(1, "a"), (3, "b")], "query_id int, fuente string")
    got = {r.query_id: (r.ndcg, round(r.f1, 4)) for r in evaluation.evaluate(frags, docs, qrels, rel).collect()}
    assert got == {1: (1.0, 0.5), 2: (0.0, 0.0), 3: (0.0, 0.5)}
    rows = {r.metric: r for r in evaluation.intervals(evaluation.evaluate(frags, docs, qrels, rel)).collect()}
    low, high = stats.bootstrap([1.0, 0.0, 0.0])
    assert (rows["ndcg"].low, rows["ndcg"].high) == (round(low, 4), round(high, 4))


def test_permutation_stream():
    """The stated generator and order of draws."""
    import random

    from tidemark.functions import stats

    a, b = [0.5, 0.7, 0.2, 0.9], [0.4, 0.8, 0.1, 0.3]
    d = [x - y for x, y in zip(a, b)]
    rng, reached = random.Random(7), 0
    for _ in range(300):
        total = 0.0
        for x in d:
            total += x if rng.random() < 0.5 else -x
        reached += abs(total / 4) >= abs(sum(d) / 4) - 1e-12
    assert stats.permutation(a, b, 300, 7)[1] == (reached + 1) / 301
    assert stats.rank_sum_counts(4) == [1, 1, 1, 2, 2, 2, 2, 2, 1, 1, 1]


def test_similar_keys_in_blocks(spark, monkeypatch):
    import numpy as np

    from tidemark.operators import graph, search

    monkeypatch.setattr(search, "KEY_BLOCK", 7)
    rng = np.random.default_rng(2)
    v = rng.normal(size=(40, 5))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "chunk_id long, vector array<double>")
    sims = v @ v.T
    want = {(i, j) for i in range(40) for j in range(40) if i != j and sims[i, j] >= 0.6}
    assert {(r.a, r.b) for r in graph.similar_keys(df, 0.6, None).collect()} == want
    few = {(i, j) for i, j in want if j in [k for k in np.argsort(-sims[i]) if k != i][:2]}
    assert {(r.a, r.b) for r in graph.similar_keys(df, 0.6, 3).collect()} == few


def test_overlaps_by_rare_grams(spark):
    """The same pairs as by all n-grams, with one n-gram that all bags hold."""
    from tidemark.operators import matching

    rng = random.Random(4)
    said = lambda: "a common line of words " + " ".join(f"w{rng.randrange(12)}" for _ in range(rng.randrange(0, 25)))
    a = spark.createDataFrame([(k, said()) for k in range(60)] + [(60, ""), (61, "one two")], "x long, t string")
    b = spark.createDataFrame([(k, said()) for k in range(30)] + [(30, "one two"), (31, "a common line of words")], "y long, t string")
    a, b = matching.bags(a, "x", "t", n=3), matching.bags(b, "y", "t", n=3)
    every = {(r.x, r.y): r.overlap for r in matching.overlaps(a, b, "x", "y").collect()}
    for least in (0.2, 0.55, 1.0):
        got = {(r.x, r.y): r.overlap for r in matching.overlaps(a, b, "x", "y", least).collect()}
        assert got == {k: v for k, v in every.items() if v >= least}


def workbook(sheets):
    """A small xlsx file: sheets of rows of cells, written as XML."""
    import io
    import zipfile

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        names = "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{k}" Target="worksheets/s{k}.xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>nombre</t></si><si><r><t>Ana </t></r><r><t>Ruiz</t></r></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        for k, rows in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {main}><sheetData>{rows}</sheetData></worksheet>")
    return out.getvalue()


def test_spreadsheets(spark):
    from tidemark.sources.binary import xlsx_text

    one = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>edad</t></is></c><c r="D1" t="str"><v>alta</v></c></row>'
        '<row r="3"><c r="A3" t="s"><v>1</v></c><c r="B3"><v>41</v></c><c r="C3"><v>2.5</v></c><c r="D3" s="1"><v>45000</v></c></row><row r="4"><c r="B4" t="b"><v>1</v></c></row>'
    )
    data = workbook({"Uno": one, "Vacia": "", "Dos": '<row><c t="str"><v>x</v></c></row><row><c><v>7</v></c></row>'})
    text = "Hoja: Uno\n\nnombre: Ana Ruiz | edad: 41 | : 2.5 | alta: 2023-03-15 00:00:00\n\nedad: True\n\nHoja: Dos\n\nx: 7"
    assert xlsx_text(data) == text
    files = spark.createDataFrame([("a.XLSX", data), ("b.xlsx", b"broken"), ("c.pdf", b"%PDF")], "fuente string, content binary")
    got = {r.fuente: r for r in readers.dispatch(files).collect()}
    assert got["a.XLSX"].texto == text and got["a.XLSX"].error is None
    assert got["b.xlsx"].error.startswith("unreadable xlsx") and got["c.pdf"].error == "no reader for pdf"


def test_vector_tiles():
    import struct

    from tidemark.sources.binary import tile_text

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    field = lambda k, data: varint(k << 3 | 2) + varint(len(data)) + data
    number = lambda k, n: varint(k << 3) + varint(n)
    values = [field(1, "Río".encode()), number(4, (1 << 64) - 5), number(6, 5), number(7, 1), varint(3 << 3 | 1) + struct.pack("<d", 2.5), field(1, b"NULL"), field(1, b" "), number(5, 300)]
    feature = lambda *tags: field(2, number(1, 9) + field(2, b"".join(map(varint, tags))) + number(3, 1) + field(4, b"\x09\x02\x02"))
    layer = field(1, b"agua") + feature(0, 0, 1, 1, 2, 2) + feature(0, 5, 1, 6) + feature(0, 3, 1, 4, 2, 7) + feature(0, 0, 1, 1, 2, 2)
    layer += b"".join(field(3, k) for k in (b"a", b"b", b"c")) + b"".join(field(4, v) for v in values) + number(5, 4096) + number(15, 2)
    assert tile_text(field(3, layer)) == "agua | a: Río | b: -5 | c: -3\nagua | a: True | b: 2.5 | c: 300"
    with pytest.raises((ValueError, IndexError)):
        tile_text(field(3, layer)[:-3])


def test_grades_of_passages_in_blocks(spark, monkeypatch):
    """Grades by brute force, where a passage that several queries judge is given once, whichever side is smaller and
    however few n-grams are held at once."""
    rng = random.Random(6)
    said = lambda n: " ".join(f"w{rng.randrange(9)}" for _ in range(n))
    given = [(q, c, said(rng.randrange(0, 14))) for q in range(3) for c in range(12)]
    passages = [(k, said(rng.randrange(1, 14))) for k in range(20)] + [(20, None), (21, given[3][2])]
    judged = [(q, k, float(1 + (q + k) % 3)) for q in range(3) for k in range(22) if (q + k) % 2]

    def bag(text):
        w = text.split()
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    def grade(q, text, least):
        a, best = bag(text), 0.0
        for j, k, g in judged:
            b = bag(dict(passages)[k] or "")
            if j == q and a & b and round(len(a & b) / min(len(a), len(b)), 6) >= least:
                best = max(best, g)
        return best

    texts = spark.createDataFrame(given, "query_id long, chunk_id long, texto string")
    judgments = spark.createDataFrame(judged, "query_id long, judged_id long, grade double")
    known = spark.createDataFrame(passages, "judged_id long, texto string")
    monkeypatch.setattr(matching, "HELD", 40)
    for some, least in ((texts, 0.3), (texts.filter("chunk_id < 5"), 0.3), (texts, 0.55)):
        want = {(q, c): grade(q, t, least) for q, c, t in given if some is texts or c < 5}
        assert len(set(want.values())) > 1
        for got in (matching.grades(some, judgments, "chunk_id", least, known), matching.grades(some, judgments.join(known, "judged_id"), "chunk_id", least)):
            assert {(r.query_id, r.chunk_id): r.grade for r in got.collect()} == want


def test_folding_without_python(spark):
    """Every character alone, between letters and before a mark, folded and composed as by unicodedata."""
    import unicodedata

    chars = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    rows = [(k, c) for k, c in enumerate(chars)] + [(-k - 1, f"x{c}é{c}̧z") for k, c in enumerate(chars)]
    # whole lines of one block, where no other character sends the text to Python
    rows += [(10**6 + k, "e" + "".join(chars[k : k + 9])) for k in range(0, 13000, 3)]
    df = spark.createDataFrame(rows + [(-(10**7), None)], "k long, t string")
    fold = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    got = df.select("t", T.without_marks(F.col("t")).alias("f"), T.nfc(F.col("t")).alias("n")).collect()
    bad = [(r.t, r.f, r.n) for r in got if r.t is not None and (r.f != fold(r.t) or r.n != unicodedata.normalize("NFC", r.t))]
    assert not bad, bad[:5]
    assert [(r.f, r.n) for r in got if r.t is None] == [(None, None)]
    plain = df.filter("k between 0 and 500").select(F.count_if(F.col("t").rlike(T._folding()[0])).alias("n")).first().n
    assert 0 < plain < 30


def against_sql(spark, folder, name, **tables):
    """Rows of a query that only Spark or only SQL has, over these tables (pandas frames)."""
    from collections import Counter

    import duckdb

    from tidemark.plans import ORACLES, QUERIES

    con = duckdb.connect()
    for table, frame in tables.items():
        frame.to_parquet(folder / f"{table}.parquet")
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    df = QUERIES[name](spark, str(folder))
    got, want = Counter(map(tuple, df.collect())), Counter(con.execute(f"select {', '.join(df.columns)} from ({ORACLES[name]})").fetchall())
    return got - want, want - got


@pytest.mark.parametrize("name", ["evl_08_borda", "evl_10_borda_three", "evl_11_indistinguishable", "evl_20_against_base"])
def test_runs_with_halves_and_touching_intervals(spark, tmp_path, name):
    """Balances whose share of 10 000 has a 5 in its fourth place, and runs exactly 0.1 apart."""
    import pandas as pd

    rng = random.Random(3)
    suppliers = pd.DataFrame({"s_suppkey": range(1, 801), "s_acctbal": [rng.randrange(-200, 2001) * 5.0 for _ in range(800)]})
    assert against_sql(spark, tmp_path, name, supplier=suppliers) == ({}, {})


def test_windows_of_texts_without_words(spark, tmp_path):
    import pandas as pd

    docs = pd.DataFrame({"doc_id": range(5), "text": ["", " \n ", None, "one", "w " * 130]})
    assert against_sql(spark, tmp_path, "chk_06_windows", documents=docs) == ({}, {})


def test_search_in_pieces(spark, monkeypatch):
    """No more similarities are held at once than CELLS, or k rows; ties by id over all pieces."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(8)
    v, q = rng.integers(-2, 3, size=(500, 3)).astype(float), rng.integers(-2, 3, size=(7, 3)).astype(float)
    ids, held, matrix = rng.permutation(500), [], search._matrix
    monkeypatch.setattr(search, "CELLS", 70)
    monkeypatch.setattr(search, "_matrix", lambda c: held.append(len(c)) or matrix(c))
    batches = [pa.RecordBatch.from_arrays([pa.array(ids[k : k + 123]), pa.array(v[k : k + 123].tolist(), pa.list_(pa.float64()))], ["c", "v"]) for k in range(0, 500, 123)]
    (out,) = search._searcher(np.arange(7), q, 6)(iter(batches))
    got = {}
    for a, b, s in zip(*(out.column(k).to_pylist() for k in range(3))):
        got.setdefault(a, []).append((-s, b))
    sims = v @ q.T
    assert got == {k: sorted((-sims[r, k], ids[r]) for r in range(500))[:6] for k in range(7)}
    assert max(held) == 10


def test_components_of_alike_keys(spark, monkeypatch):
    """The components of all pairs, from at most a row per key and two blocks."""
    import numpy as np

    monkeypatch.setattr(search, "FOREST_BLOCK", 16)
    monkeypatch.setattr(search, "CELLS", 20)
    rng = np.random.default_rng(5)
    v = rng.normal(size=(90, 4))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    ids = [int(k) for k in rng.permutation(1000)[:90]]
    df = spark.createDataFrame([(k, x.tolist()) for k, x in zip(ids, v)], "chunk_id long, vector array<double>")
    for least in (0.85, 0.95, 0.99):
        want = {(r.clave, r.id) for r in graph.merge_similar(graph.similar_keys(df, least, None)).collect()}
        assert {(r.clave, r.id) for r in graph.merge_alike(df, least).collect()} == want
    assert search.similar_forest(df, 0.85).count() < graph.similar_keys(df, 0.85, None).count()


def test_texts_in_slices(monkeypatch):
    """No slice holds more than SLICE bytes besides its first text or list, and all rows come in order."""
    import pyarrow as pa

    monkeypatch.setattr(T, "SLICE", 10)
    lists = pa.array([["abc", "defg"], None, [], ["h" * 40], ["ij"], ["kl", None]], pa.list_(pa.string()))
    for part in (lists, lists[1:5], lists[:0]):
        got = [x.to_pylist() for x in T.list_slices(part)]
        assert sum(got, []) == part.to_pylist()
        assert all(sum(len(t or "") for u in x[1:] for t in u or []) <= 10 for x in got)
    assert len(list(T.list_slices(lists))) == 3


def test_keys_of_plain_and_other_names(spark):
    """A key is the same whether or not its name is its own key, and entities count mentions, documents and forms."""
    names = ["the part 1", "The  Part 1", " part 1", "part 1 ", "part-1", "the", "the ", "The, Part 1", "párt 1", "la ½ parte", "", "a_b c", "part\t1", "ﬁn 1"]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "k long, t string")
    got = {r.k: r.v for r in df.select("k", T.name_key(F.col("t")).alias("v")).collect()}
    assert [got[k] for k in range(len(names))] == ["part 1", "part 1", "part 1", "part 1", "part 1", "the", "the", "part 1", "part 1", "1 2 parte", "", "a_b c", "part 1", "fin 1"]
    rows = [(k % 4, k % 3, n, "x" if k % 5 else "y") for k, n in enumerate(names * 2)]
    entities, ids = graph.canonical(spark.createDataFrame(rows, "chunk_id long, doc_id long, texto string, tipo string"))
    want = {}
    for _, doc, name, kind in rows:
        if key := got[names.index(name)]:
            want.setdefault(key, []).append((doc, name, kind))
    most = lambda xs: min(set(xs), key=lambda x: (-xs.count(x), x))
    found = {r.id: (r.nombre, r.tipo, list(r.alias), r.df) for r in entities.collect()}
    assert found == {k: (most([n for _, n, _ in v]), most([t for *_, t in v]), sorted({n for _, n, _ in v}), len({d for d, *_ in v})) for k, v in want.items()}
    assert sorted((r.clave, r.id) for r in ids.collect()) == sorted((k, k) for k in want)
