"""Knowledge graph as two tables: nodes (id, kind, ...) and edges (src, dst, kind, ...)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config
from tidemark.functions.text import admissible, evidence, name_key, strip
from tidemark.sources.lineage import cut

# Window width and overlap, and the ordered relation patterns (type, pattern, passive).
WINDOW, STEP = 1200, 1000
NAME = r"\b[A-ZÁÉÍÓÚÑ][\w\-]+(?:\s+[A-ZÁÉÍÓÚÑ][\w\-]+)*"
RELATIONS = [
    ("desarrolla", r"desarrollad[oa]s? por|desenvolvid[oa]s? por|developed by", True),
    ("opera", r"operad[oa]s? por|operated by|gestionad[oa]s? por|managed by", True),
    ("regula", r"regulad[oa]s? por|regulated by|governed by|sujet[oa]s? a|subject to", True),
    ("financia", r"financiad[oa]s? por|funded by|financed by|financiad[oa]s? pel[oa]", True),
    ("produce", r"producid[oa]s? por|fabricad[oa]s? por|produced by|manufactured by", True),
    ("lanza", r"lanzad[oa]s? por|launched by|lançad[oa]s? por", True),
    ("desarrolla", r"desarroll(?:a|an|ó|aron|ando)|desenvolve[m]?|desenvolveu|develops?|developing", False),
    ("opera", r"opera[n]?|operó|operates?|operating|gestiona[n]?|manages?", False),
    ("regula", r"regula[n]?|reguló|regulates?|regulating|governs?|prohíbe[n]?|prohibits?", False),
    ("financia", r"financia[n]?|financió|funds|finances|subvenciona[n]?", False),
    ("produce", r"produce[n]?|produjo|produces?|fabrica[n]?|manufactures?", False),
    ("lanza", r"lanza[n]?|lanzó|launches|launched|lança|lançou", False),
    ("colabora_con", r"colabora con|coopera con|cooperates? with|collaborates? with|in partnership with|junto con|em parceria com|acuerdo con|agreement with", False),
    ("miembro_de", r"miembro de|member of|membro de|forma parte de|part of|integra", False),
    ("ubicado_en", r"con sede en|headquartered in|sediad[oa] em|ubicad[oa]s? en|located in|situad[oa]s? en|based in", False),
    ("firma", r"firma[n]?|firmó|signs?|signed|suscribe[n]?|suscribió|assina|assinou", False),
]


def windows(chunks: DataFrame) -> DataFrame:
    """(chunk_id, desde, hasta, ventana): overlapping windows of characters; blank ones are left out."""
    n = F.length("texto")
    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(STEP)), lambda s: (s == 0) | (s + (WINDOW - STEP) < n))
    rows = chunks.select("chunk_id", "texto", F.explode(starts).alias("desde"))
    rows = rows.withColumns({"hasta": F.least(F.col("desde") + WINDOW, F.length("texto")), "ventana": F.substr("texto", F.col("desde") + 1, F.lit(WINDOW))})
    return rows.filter(strip(F.col("ventana")) != "").select("chunk_id", "desde", "hasta", "ventana")


def locate(text: Column, surface: Column, start: Column, end: Column) -> Column:
    """Offsets of a surface form: the stated ones if they hold, else the first occurrence, else null."""
    stated = F.substr(text, start + 1, end - start) == surface
    found = F.position(surface, text)
    return F.when(stated, F.struct(start.alias("inicio"), end.alias("fin"))).when(found > 0, F.struct((found - 1).alias("inicio"), (found - 1 + F.length(surface)).alias("fin")))


_NAMES = T.ArrayType(T.StructType([T.StructField("texto", T.StringType()), T.StructField("inicio", T.IntegerType()), T.StructField("fin", T.IntegerType())]))


@F.pandas_udf(_NAMES)
def capital_names(text: pd.Series) -> pd.Series:
    """Chained capitalised words with their offsets: the deterministic recogniser."""
    pattern = re.compile(NAME)
    return text.map(lambda t: [{"texto": m.group(), "inicio": m.start(), "fin": m.end()} for m in pattern.finditer(t or "")])


def recogniser(name: str):
    """The recogniser by name. Model-backed ones need their models, which this library doesn't bring."""
    if name == "falso":
        return capital_names
    if name in ("gliner2", "onnx"):
        raise RuntimeError(f"recogniser {name} needs a model; pass a function of your own to mentions()")
    raise ValueError(f"unknown recogniser {name}")


def mentions(chunks: DataFrame, recognise=capital_names) -> DataFrame:
    """chunks (chunk_id, doc_id, texto) to (chunk_id, doc_id, texto, tipo, inicio, fin, confianza): windows are recognised
    on their own, offsets are shifted, and each span is kept once, with the highest confidence."""
    wins = windows(chunks).select("chunk_id", "desde", F.explode(recognise(F.col("ventana"))).alias("m"))
    rows = wins.select(
        "chunk_id", F.col("m.texto").alias("texto"), F.lit("organizacion").alias("tipo"), (F.col("m.inicio") + F.col("desde")).alias("inicio"),
        (F.col("m.fin") + F.col("desde")).alias("fin"), F.lit(1.0).alias("confianza"), "desde",
    ).filter(admissible(F.col("texto")))
    best = Window.partitionBy("chunk_id", "inicio", "fin").orderBy(F.desc("confianza"), "desde")
    rows = rows.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n", "desde")
    return rows.join(chunks.select("chunk_id", "doc_id"), "chunk_id").select("chunk_id", "doc_id", "texto", "tipo", "inicio", "fin", "confianza")


def with_keys(found: DataFrame) -> DataFrame:
    """Mentions with the key of their name. A key is made of column functions (only rarer characters go to Python), which
    costs less than to shuffle all mentions to the keys of their distinct names."""
    return found.withColumn("clave", name_key(F.col("texto")))


def canonical(found: DataFrame, equal: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Entities (id, nombre, tipo, alias, df) and the map from key to id. equal: (clave, id) pairs of keys that are one.

    Names, types and aliases come from the counts of distinct names, which are written once; of the mentions themselves
    only pairs of entity and document are shuffled.
    """
    rows = with_keys(found).filter("clave <> ''")

    def named(rows: DataFrame) -> DataFrame:
        if equal is None:
            return rows.withColumn("id", F.col("clave"))
        return rows.join(equal.select("clave", F.col("id").alias("_id")), "clave", "left").withColumn("id", F.coalesce("_id", "clave")).drop("_id")

    counts = cut(named(rows.groupBy("clave", "texto", "tipo").agg(F.count(F.lit(1)).alias("_n"))))

    def most(column: str, name: str, *more: Column) -> DataFrame:
        each = counts.groupBy("id", column).agg(F.sum("_n").alias("_n"))
        return each.groupBy("id").agg(F.min_by(column, F.struct(-F.col("_n"), column)).alias(name), *more)

    names = most("texto", "nombre", F.array_sort(F.collect_list("texto")).alias("alias"))
    docs = named(rows.select("clave", "doc_id")).select("id", "doc_id").distinct().groupBy("id").agg(F.count("doc_id").alias("df"))
    out = names.join(most("tipo", "tipo"), "id").join(docs, "id")
    return out.select("id", "nombre", "tipo", "alias", "df"), counts.select("clave", "id").distinct()


def merge_similar(similar: DataFrame) -> DataFrame:
    """(clave, id) from pairs (a, b) of similar keys: connected components by repeated smallest labels, in tables.

    The lineage is cut each round by a checkpoint in the shared folder.
    """
    edges = cut(similar.select("a", "b").unionByName(similar.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("id")).select(F.col("a").alias("clave"), "id")
    while True:
        near = edges.join(labels.select(F.col("clave").alias("b"), "id"), "b").groupBy(F.col("a").alias("clave")).agg(F.min("id").alias("_n"))
        met = cut(labels.join(near, "clave").select("clave", F.least("id", "_n").alias("id"), F.col("id").alias("_old")))
        # and then the label of the label: widths halve each round
        jump = met.select(F.col("clave").alias("id"), F.col("id").alias("_far"))
        new = cut(met.join(jump, "id", "left").select("clave", F.least("id", F.coalesce("_far", "id")).alias("id"), "_old"))
        labels = new.select("clave", "id")
        if not new.filter("id <> _old").limit(1).count():
            return labels


def merge_alike(vectors: DataFrame, threshold: float = 0.92) -> DataFrame:
    """(clave, id) as merge_similar(similar_keys(vectors, threshold, None)), without a table of all pairs."""
    from tidemark.operators.search import similar_forest

    return merge_similar(similar_forest(vectors, threshold))


def similar_keys(vectors: DataFrame, threshold: float = 0.92, neighbours: int | None = 9) -> DataFrame:
    """Pairs (a, b) with at least this similarity, of each key's nearest neighbours (None: of all); vectors: chunk_id,
    vector. A key counts as the nearest neighbour of itself."""
    from tidemark.operators.search import all_similar

    pairs = all_similar(vectors, threshold)
    if neighbours is not None:
        best = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
        pairs = pairs.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") < neighbours)
    return pairs.select("a", "b")


def admitted(entities: DataFrame, documents: int, least: int = config.GRAPH_MIN_DF, share: float = config.GRAPH_MAX_DF_SHARE) -> DataFrame:
    """Entities that are neither too rare nor in too large a share of documents."""
    return entities.filter(F.col("df").between(least, max(least, int(documents * share))))


def relation_of(gap: Column) -> Column:
    """struct(tipo, pasiva) of the first pattern that a gap between two mentions holds; null for none."""
    out = F.lit(None).cast("struct<tipo: string, pasiva: boolean>")
    for kind, pattern, passive in RELATIONS[::-1]:
        out = F.when(gap.rlike(rf"(?iU)\b(?:{pattern})\b"), F.struct(F.lit(kind).alias("tipo"), F.lit(passive).alias("pasiva"))).otherwise(out)
    return out


def sentence_spans(chunks: DataFrame) -> DataFrame:
    """(chunk_id, oracion, desde, hasta): where each sentence lies; one that isn't found is skipped."""
    from tidemark.functions.text import sentences

    start = F.struct(F.array().cast("array<struct<desde: int, hasta: int>>").alias("out"), F.lit(1).alias("at"))

    def add(st: Column, s: Column) -> Column:
        p = F.position(s, F.col("texto"), st["at"])
        hit = F.struct((p - 1).alias("desde"), (p - 1 + F.length(s)).alias("hasta"))
        return F.struct(F.when(p > 0, F.array_append(st["out"], hit)).otherwise(st["out"]).alias("out"), F.when(p > 0, p + F.length(s)).otherwise(st["at"]).alias("at"))

    spans = F.aggregate(sentences(F.col("texto")), start, add, lambda st: st["out"])
    return chunks.select("chunk_id", F.posexplode(spans).alias("oracion", "s")).select("chunk_id", "oracion", "s.desde", "s.hasta")


def triples(found: DataFrame, spans: DataFrame, chunks: DataFrame, ids: DataFrame) -> DataFrame:
    """(chunk_id, doc_id, sujeto, tipo, objeto, evidencia) of neighbouring mentions in a sentence with a relation between."""
    rows = with_keys(found).join(ids, "clave").select("chunk_id", "doc_id", "id", "inicio", "fin")
    inside = rows.join(spans, "chunk_id").filter((F.col("inicio") >= F.col("desde")) & (F.col("fin") <= F.col("hasta")))
    order = Window.partitionBy("chunk_id", "oracion").orderBy("inicio", "fin")
    nxt = inside.withColumns({"_id": F.lead("id").over(order), "_at": F.lead("inicio").over(order)}).filter("_id IS NOT NULL")
    nxt = nxt.filter((F.col("_at") - F.col("fin")).between(1, 60)).join(chunks.select("chunk_id", "texto"), "chunk_id")
    nxt = nxt.withColumn("r", relation_of(F.substr("texto", F.col("fin") + 1, F.col("_at") - F.col("fin")))).filter("r IS NOT NULL")
    out = nxt.select(
        "chunk_id", "doc_id", F.when(F.col("r.pasiva"), F.col("_id")).otherwise(F.col("id")).alias("sujeto"), F.col("r.tipo").alias("tipo"),
        F.when(F.col("r.pasiva"), F.col("id")).otherwise(F.col("_id")).alias("objeto"), evidence(F.substr("texto", F.col("desde") + 1, F.col("hasta") - F.col("desde"))).alias("evidencia"), "oracion", "inicio",
    ).filter("sujeto <> objeto")
    once = Window.partitionBy("chunk_id", "sujeto", "tipo", "objeto").orderBy("oracion", "inicio")
    return out.withColumn("_n", F.row_number().over(once)).filter("_n = 1").drop("_n", "oracion", "inicio")


def build(found: DataFrame, entities: DataFrame, ids: DataFrame, found_triples: DataFrame, per_chunk: int = config.GRAPH_PER_CHUNK) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, kind, nombre) and edges (src, dst, kind, tipo, n) of admitted entities, their chunks and documents."""
    known = ids.join(entities.select("id"), "id", "left_semi")
    rows = with_keys(found).select("chunk_id", "doc_id", "clave").join(known, "clave").select("chunk_id", "doc_id", "id")
    # dealt by chunk once, for the counts, their order and what is distinct of them
    counts = rows.repartition("chunk_id").groupBy("chunk_id", "doc_id", "id").agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("chunk_id").orderBy(F.desc("n"), "id")
    counts = counts.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= per_chunk)
    tag = lambda kind, c: F.concat(F.lit(f"{kind}:"), F.col(c).cast("string"))
    none = F.lit(None).cast("string")
    nodes = entities.select(tag("E", "id").alias("id"), F.lit("entidad").alias("kind"), "nombre")
    nodes = nodes.unionByName(counts.select("chunk_id").distinct().select(tag("C", "chunk_id").alias("id"), F.lit("fragmento").alias("kind"), none.alias("nombre")))
    nodes = nodes.unionByName(counts.select("doc_id").distinct().select(tag("D", "doc_id").alias("id"), F.lit("documento").alias("kind"), none.alias("nombre")))
    edges = counts.select(tag("C", "chunk_id").alias("src"), tag("E", "id").alias("dst"), F.lit("MENCIONA").alias("kind"), none.alias("tipo"), F.col("n").cast("long").alias("n"))
    holds = counts.select("doc_id", "chunk_id").distinct().select(tag("D", "doc_id").alias("src"), tag("C", "chunk_id").alias("dst"))
    edges = edges.unionByName(holds.select("src", "dst", F.lit("CONTIENE").alias("kind"), none.alias("tipo"), F.lit(1).cast("long").alias("n")))
    known = entities.select("id")
    rel = found_triples.join(known.withColumnRenamed("id", "sujeto"), "sujeto", "left_semi").join(known.withColumnRenamed("id", "objeto"), "objeto", "left_semi")
    rel = rel.groupBy("sujeto", "objeto").agg(F.min_by("tipo", F.struct("chunk_id", "tipo")).alias("tipo"), F.count(F.lit(1)).alias("n"))
    return nodes, edges.unionByName(rel.select(tag("E", "sujeto").alias("src"), tag("E", "objeto").alias("dst"), F.lit("RELACION").alias("kind"), "tipo", "n"))


def summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    a = nodes.groupBy(F.concat(F.lit("nodo "), F.col("kind")).alias("clase")).agg(F.count(F.lit(1)).alias("n"))
    return a.unionByName(edges.groupBy(F.concat(F.lit("arista "), F.col("kind")).alias("clase")).agg(F.count(F.lit(1)).alias("n")))


def alias_index(entities: DataFrame) -> DataFrame:
    """(clave, id): an entity's own key always counts; an alias only fills a gap, the smallest id first."""
    own = entities.select(F.col("id").alias("clave"), "id")
    other = entities.select("id", F.explode("alias").alias("_a")).select(name_key(F.col("_a")).alias("clave"), "id")
    other = other.filter("clave <> ''").join(own.select("clave"), "clave", "left_anti").groupBy("clave").agg(F.min("id").alias("id"))
    return own.unionByName(other)


def query_entities(surfaces: DataFrame, alias: DataFrame) -> DataFrame:
    """surfaces (query_id, ord, texto) to distinct (query_id, id) with the first place of each."""
    rows = surfaces.withColumn("clave", name_key(F.col("texto"))).join(alias, "clave")
    return rows.groupBy("query_id", "id").agg(F.min("ord").alias("ord"))


def rank_by_entities(wanted: DataFrame, edges: DataFrame, k: int = config.GRAPH_CANDIDATES, neighbour: float = config.GRAPH_NEIGHBOUR) -> DataFrame:
    """(query_id, chunk, score, rank): chunks that mention a query's entities (weight 1) or related ones (less)."""
    rel = edges.filter("kind = 'RELACION'").select("src", "dst")
    both = rel.unionByName(rel.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    direct = wanted.select("query_id", F.concat(F.lit("E:"), F.col("id")).alias("e")).withColumn("w", F.lit(1.0))
    near = direct.select("query_id", F.col("e").alias("src")).join(both, "src").select("query_id", F.col("dst").alias("e")).withColumn("w", F.lit(neighbour))
    weights = direct.unionByName(near).groupBy("query_id", "e").agg(F.max("w").alias("w"))
    said = edges.filter("kind = 'MENCIONA'").select(F.col("src").alias("chunk"), F.col("dst").alias("e"), "n")
    score = F.round(F.sum(F.col("w") * (1 + (F.col("n") - 1) * 0.25)), config.TAU_DIGITS)
    out = weights.join(said, "e").groupBy("query_id", "chunk").agg(score.alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk")
    return out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def graphml(nodes: DataFrame, edges: DataFrame) -> Iterator[str]:
    """The graph as GraphML lines, streamed through the driver; nulls become empty strings."""
    from xml.sax.saxutils import quoteattr

    yield '<graphml><graph edgedefault="directed">'
    for r in nodes.na.fill("").toLocalIterator():
        yield f"<node id={quoteattr(r['id'])} kind={quoteattr(r['kind'])} nombre={quoteattr(r['nombre'])}/>"
    for r in edges.na.fill("").toLocalIterator():
        yield f"<edge source={quoteattr(r['src'])} target={quoteattr(r['dst'])} kind={quoteattr(r['kind'])} tipo={quoteattr(r['tipo'])} n=\"{r['n']}\"/>"
    yield "</graph></graphml>"


def export_graphml(nodes: DataFrame, edges: DataFrame, path: str) -> str:
    """Write the graph as a GraphML file on the driver, row by row; columns that aren't scalar are an error."""
    if bad := not_scalar(nodes) + not_scalar(edges):
        raise ValueError("GraphML can't hold " + "; ".join(bad))
    with open(path, "w", encoding="utf-8") as out:
        out.writelines(line + "\n" for line in graphml(nodes, edges))
    return path


def not_scalar(df: DataFrame) -> list[str]:
    """Columns whose type GraphML can't hold."""
    return [f"{name}: {kind}" for name, kind in df.dtypes if kind.startswith(("array", "map", "struct", "binary", "variant"))]


def as_ranking(ranked: DataFrame, chunks: DataFrame, encoder: str = "grafo", order: int = 9) -> DataFrame:
    """Chunks ranked by entities as rows of the rankings table, those unknown to the index left out and ranks closed."""
    known = ranked.withColumn("chunk_id", F.regexp_replace("chunk", "^C:", "").try_cast("long")).join(chunks.select("chunk_id"), "chunk_id", "left_semi")
    best = Window.partitionBy("query_id").orderBy("rank")
    return known.select("query_id", F.lit(encoder).alias("encoder"), F.lit(order).alias("enc_ord"), F.row_number().over(best).alias("rank"), "chunk_id", F.col("score").alias("sim"))
