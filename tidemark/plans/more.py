"""Queries of operators that share their function with a neighbour, or whose inputs are made of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import stats
from tidemark.operators import evaluation, experiments, fusion, matching, output, sampling, search
from tidemark.plans.corpus import _MENTIONS, _OVERLAPS, _mentions
from tidemark.plans.registry import BASE, CONVEX, RRF, Tables, pooled, query
from tidemark.plans.retrieval import _METRICS, _RUNS, _runs, _scored
from tidemark.sources import readers, sinks

# sources


@query("src_02_codes", "SELECT s_suppkey, upper(left(n_name, 3)) AS codigo FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def _(t: Tables):
    codes = t.nation.select(F.col("n_name").alias("observatorio"), F.upper(F.left("n_name", F.lit(3))).alias("codigo"))
    codes = codes.unionByName(t.nation.select(F.col("n_name").alias("observatorio"), F.lit("=A1").alias("codigo")))
    inv = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("s_suppkey").alias("fila"), F.lit(1).alias("fenomeno"), F.col("n_name").alias("observatorio"), F.lit("a.pdf").alias("fuente"),
    )
    return readers.catalogue(inv, codes).select("s_suppkey", "codigo")


@query("src_03_dispatch", """
WITH f AS (SELECT c_custkey, ['txt', 'json', 'csv', 'png', 'xyz', 'json'][1 + c_custkey % 6] AS e, c_custkey % 6 AS k, c_name AS n FROM customer)
SELECT c_custkey || '.' || e AS fuente, e AS formato, CASE k WHEN 0 THEN n WHEN 1 THEN 'nombre: ' || n WHEN 2 THEN 'a: ' || n || chr(10) || chr(10) || 'a: fin' WHEN 3 THEN '' END AS texto,
  k <= 3 AS necesita_ocr, CASE k WHEN 4 THEN 'no reader for xyz' WHEN 5 THEN 'invalid json' END AS error FROM f""")
def _(t: Tables):
    k, n = F.col("c_custkey") % 6, F.col("c_name")
    ext = F.element_at(F.array(*[F.lit(x) for x in ("txt", "json", "csv", "png", "xyz", "json")]), (k + 1).cast("int"))
    body = F.when(k == 0, n).when(k == 1, F.concat(F.lit('{"nombre": "'), n, F.lit('"}'))).when(k == 2, F.concat(F.lit("a\n"), n, F.lit("\nfin\n"))).otherwise(F.lit("{not json"))
    files = t.customer.select(F.concat("c_custkey", F.lit("."), ext).alias("fuente"), F.encode(body, "UTF-8").alias("content"))
    return readers.dispatch(files)


@query("src_06_json_article", "SELECT c_custkey, 'articulo' AS clase, c_name || chr(10) || chr(10) || c_mktsegment || chr(10) || c_custkey AS texto FROM customer")
def _(t: Tables):
    body = F.to_json(F.struct(F.col("c_name").alias("titulo"), F.array("c_mktsegment", F.col("c_custkey").cast("string")).alias("content")))
    return t.customer.select("c_custkey", readers.json_document(body).alias("d")).select("c_custkey", "d.clase", "d.texto")


@query("src_07_json_catalogue", "SELECT c_custkey, 'catalogo' AS clase, 'n: ' || c_name || chr(10) || chr(10) || 'n: ' || c_mktsegment AS texto FROM customer")
def _(t: Tables):
    body = F.to_json(F.array(F.struct(F.col("c_name").alias("n")), F.struct(F.col("c_mktsegment").alias("n"))))
    return t.customer.select("c_custkey", readers.json_document(body).alias("d")).select("c_custkey", "d.clase", "d.texto")


@query("src_09_csv_rows", "SELECT c_custkey, unnest(['k: ' || c_custkey || ' | n: ' || c_name || chr(10) || 'x', 'n: ' || c_mktsegment]) AS texto FROM customer")
def _(t: Tables):
    text = F.concat(F.lit("k,n\n"), "c_custkey", F.lit(',"'), "c_name", F.lit('\nx"\n,'), "c_mktsegment", F.lit("\n,\n"))
    return t.customer.select("c_custkey", F.explode(readers.csv_texts(text)).alias("texto"))


@query("src_13_plain_text", "SELECT doc_id, text AS texto FROM documents")
def _(t: Tables):
    latin = F.encode("text", "ISO-8859-1")
    fits = F.decode(latin, "ISO-8859-1") == F.col("text")
    return t.documents.select("doc_id", readers.decoded(F.when(fits & (F.col("doc_id") % 2 == 0), latin).otherwise(F.encode("text", "UTF-8"))).alias("texto"))


@query("src_14_images", "SELECT p_partkey, '' AS texto, true AS necesita_ocr FROM part")
def _(t: Tables):
    return readers.image_document(t.part.select("p_partkey"))


@query("src_24_index", "SELECT vec_id AS pos, label::BIGINT AS label, round(embedding[1]::DOUBLE, 6) AS primero FROM embeddings")
def _(t: Tables):
    rows = t.embeddings.select(F.col("vec_id").alias("pos"), "label", "embedding")
    out = readers.load_index(rows.select("pos", "embedding"), rows.select("pos", F.col("label").cast("long").alias("label")))
    return out.select("pos", "label", F.round(F.element_at("embedding", 1).cast("double"), 6).alias("primero"))


@query("src_30_entity_cache", _MENTIONS.split("form AS")[0].rstrip().rstrip(",") + " SELECT chunk_id, doc_id, texto, l_linenumber * 20 AS inicio FROM m")
def _(t: Tables):
    return readers.mention_rows(sinks.entity_cache(_mentions(t))).select("chunk_id", "doc_id", "texto", "inicio")


@query("src_33_source_first", "SELECT doc_id, arg_min(source, id) AS fuente FROM (SELECT doc_id // 3 AS doc_id, doc_id AS id, source FROM documents) GROUP BY 1")
def _(t: Tables):
    rows = t.documents.select(F.floor(F.col("doc_id") / 3).alias("doc_id"), F.col("doc_id").alias("chunk_id"), F.col("source").alias("fuente"))
    return readers.source_of_documents(rows)


@query("snk_04_queries", "SELECT printf('q%03d', c_custkey) AS query_id, CASE WHEN c_custkey BETWEEN 1 AND 16 THEN 1 WHEN c_custkey BETWEEN 17 AND 32 THEN 2 WHEN c_custkey BETWEEN 33 AND 50 THEN 3 END::BIGINT AS fenomeno FROM customer")
def _(t: Tables):
    from tidemark.functions.text import phenomenon_of

    return sinks.queries_with_phenomenon(t.customer.select(F.format_string("q%03d", "c_custkey").alias("query_id")), phenomenon_of)


@query("snk_05_ranking_cache", BASE + "SELECT query_id, count(*) FILTER (encoder = 'a') AS a, count(*) FILTER (encoder = 'b') AS b, round(max(sim), 6) AS mejor FROM rankings GROUP BY 1")
def _(t: Tables):
    r = sinks.ranking_cache(t.rankings())
    best = F.greatest(*[F.array_max(F.transform(F.col("rankings")[k], lambda x: x["sim"])) for k in "ab"])
    return r.select("query_id", *[F.size(F.col("rankings")[k]).alias(k) for k in "ab"], best.alias("mejor"))


@query("snk_11_ocr_cache", "SELECT doc_id FROM documents WHERE n_chars < 400 AND doc_id % 3 > 0 AND doc_id % 5 > 0")
def _(t: Tables):
    docs = t.documents.select("doc_id", F.col("text").alias("texto"), (F.col("n_chars") < 400).alias("necesita_ocr"))
    done = readers.apply_ocr(docs, docs.filter("doc_id % 3 = 0").select("doc_id", F.lit("ocr").alias("texto")))
    return readers.pending_ocr(done, docs.filter("doc_id % 5 = 0"))


# search and fusion


@query("vec_09_stage", BASE + "SELECT query_id, rank, chunk_id, round(sim, 6) AS sim FROM rankings WHERE encoder = 'b'")
def _(t: Tables):
    return search.top_k(t.indices()["b"], t.query_vectors()["b"], 50).select("query_id", "rank", "chunk_id", F.round("sim", 6).alias("sim"))


@query("fus_11_pool", BASE + RRF + pooled("s[1]", top=10) + "SELECT query_id, rank, doc_id, fuente, round(score, 6) AS score FROM documents3")
def _(t: Tables):
    return fusion.pool_documents(fusion.boost(t.candidates()), 10, "max").withColumn("score", F.round("score", 6))


@query("fus_15_strict_pool", BASE + RRF + pooled("list_sum(s[1:4]) / len(s[1:4])") + "SELECT query_id, rank, doc_id, fuente, round(score, 6) AS score FROM documents3")
def _(t: Tables):
    return fusion.pool_documents(fusion.boost(t.candidates()), 3, "top4", strict=True).withColumn("score", F.round("score", 6))


@query("fus_16_dispatch", BASE + CONVEX + "SELECT 'convex' AS fusion, query_id, chunk_id, round(score, 6) AS score, pos FROM candidates UNION ALL SELECT 'rrf', query_id, chunk_id, round(sum(1.0::DOUBLE / (60 + rank)), 6), row_number() OVER (PARTITION BY query_id ORDER BY round(sum(1.0::DOUBLE / (60 + rank)), 9) DESC, min(enc_ord * 1000 + rank)) FROM rankings GROUP BY query_id, chunk_id")
def _(t: Tables):
    parts = [fusion.fuse(t.rankings(), m).select(F.lit(m).alias("fusion"), "query_id", "chunk_id", F.round("score", 6).alias("score"), "pos") for m in ("convex", "rrf")]
    return parts[0].unionByName(parts[1])


# evaluation, statistics, experiments


@query("evl_06_by_query", _METRICS + "SELECT query_id, round(ndcg, 6) AS ndcg, round(f1, 6) AS f1 FROM scored")
def _(t: Tables):
    return _scored(t).select("query_id", F.round("ndcg", 6).alias("ndcg"), F.round("f1", 6).alias("f1"))


@query("evl_09_borda_f1", f"WITH {_RUNS} SELECT idx, count(*) OVER () - row_number() OVER (ORDER BY f1 DESC, idx) AS puntos FROM runs")
def _(t: Tables):
    return evaluation.borda(_runs(t), ("f1",)).select("idx", "puntos")


@query("evl_10_borda_three", f"WITH {_RUNS}, r AS (SELECT *, round(ndcg * f1, 6) AS p FROM runs) SELECT idx, count(*) OVER () * 3 - row_number() OVER (ORDER BY ndcg DESC, idx) - row_number() OVER (ORDER BY f1 DESC, idx) - row_number() OVER (ORDER BY p DESC, idx) AS puntos FROM r")
def _(t: Tables):
    return evaluation.borda(_runs(t).withColumn("p", F.round(F.col("ndcg") * F.col("f1"), 6)), ("ndcg", "f1", "p")).select("idx", "puntos")


@query("evl_17_current", BASE + CONVEX + _METRICS[len(BASE + RRF):] + "SELECT query_id, round(ndcg, 6) AS ndcg, round(f1, 6) AS f1 FROM scored")
def _(t: Tables):
    return _scored(t, fusion="convex").select("query_id", F.round("ndcg", 6).alias("ndcg"), F.round("f1", 6).alias("f1"))


@query("sta_03_rank_sums", "SELECT n, s, count(*) AS formas FROM (SELECT n, list_sum(list_transform(range(1, n + 1), lambda k: k * ((b >> (k - 1)) & 1)))::BIGINT AS s FROM range(1, 11) t(n), range(1024) u(b) WHERE b < (1 << n)) GROUP BY 1, 2")
def _(t: Tables):
    rows = [(n, s, c) for n in range(1, 11) for s, c in enumerate(stats.rank_sum_counts(n))]
    return t.spark.createDataFrame(rows, "n long, s long, formas long")


@query("exp_03_grid_plan", "SELECT c.c AS chunk, s.s AS solape, e.e AS encoders, k.k AS k0 FROM (SELECT unnest([256, 504])::BIGINT AS c) c, (SELECT unnest([0.0, 0.15])::DOUBLE AS s) s, (SELECT unnest(['a', 'b', 'c', 'a+b', 'a+c', 'b+c']) AS e) e, (SELECT unnest([30, 60])::BIGINT AS k) k")
def _(t: Tables):
    plan = experiments.grid_plan(t.spark, [256, 504], [0.0, 0.15], ["a", "b", "c"], 2, {"fusion": ["rrf"], "k0": [30, 60]})
    return plan.select("chunk", "solape", F.array_join("encoders", "+").alias("encoders"), "k0")


@query("exp_10_simple_grid", "SELECT f AS fusion, round(b, 2)::DOUBLE AS factor FROM (SELECT unnest(['rrf', 'combsum']) AS f), (SELECT unnest([1.0, 1.05, 1.1]) AS b)")
def _(t: Tables):
    return experiments.policies(t.spark, {"fusion": ["rrf", "combsum"], "factor": [1.0, 1.05, 1.1]}).select("fusion", "factor")


# matching and samples


@query("mat_04_batch_grades", _OVERLAPS + "SELECT d.doc_id, coalesce(max(1 + o.item_id % 2), 0)::DOUBLE AS grade FROM documents d LEFT JOIN o ON o.doc_id = d.doc_id AND o.overlap >= 0.3 GROUP BY 1")
def _(t: Tables):
    texts = t.documents.select(F.lit(1).alias("query_id"), "doc_id", F.col("text").alias("texto"))
    judged = t.benchmark.select(F.lit(1).alias("query_id"), F.col("item_id").alias("judged_id"), (1.0 + F.col("item_id") % 2).alias("grade"), F.col("text").alias("texto"))
    return matching.grades(texts, judged, "doc_id", 0.3).select("doc_id", "grade")


@query("mat_05_grades_by_query", _OVERLAPS + "SELECT d.doc_id % 3 AS query_id, d.doc_id, coalesce(max(1 + o.item_id % 2), 0)::DOUBLE AS grade FROM documents d LEFT JOIN o ON o.doc_id = d.doc_id AND o.overlap >= 0.55 AND o.item_id % 3 = d.doc_id % 3 GROUP BY 1, 2")
def _(t: Tables):
    texts = t.documents.select((F.col("doc_id") % 3).alias("query_id"), "doc_id", F.col("text").alias("texto"))
    judged = t.benchmark.select((F.col("item_id") % 3).alias("query_id"), F.col("item_id").alias("judged_id"), (1.0 + F.col("item_id") % 2).alias("grade"), F.col("text").alias("texto"))
    return matching.grades(texts, judged, "doc_id", config.MATCH_THRESHOLD)


@query("smp_04_unjudged", BASE + """
, j AS (SELECT l_orderkey % 20 AS query_id, l_partkey % 500 AS chunk_id FROM lineitem WHERE l_linenumber = 1)
SELECT query_id, chunk_id FROM (SELECT DISTINCT query_id, chunk_id FROM rankings WHERE rank <= 15) ANTI JOIN j USING (query_id, chunk_id)""")
def _(t: Tables):
    judged = t.lineitem.filter("l_linenumber = 1").select(
        (F.col("l_orderkey") % 20).alias("query_id"), (F.col("l_partkey") % 500).alias("chunk_id"), F.lit(1.0).alias("grade"), F.lit(False).alias("doc"), F.col("l_orderkey").alias("ord"),
    )
    return sampling.consolidate_latest(sampling.pool(t.rankings()), judged)[2]


@query("out_05_pieces", "SELECT conv_id, turn, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))::BIGINT AS palabras FROM conversations WHERE len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) > 0")
def _(t: Tables):
    rows = t.conversations.select("conv_id", "turn", F.explode(output.pieces(F.col("text"), 250)).alias("p"))
    from tidemark.functions.text import word_count

    return rows.groupBy("conv_id", "turn").agg(F.sum(word_count(F.col("p"))).alias("palabras"))
