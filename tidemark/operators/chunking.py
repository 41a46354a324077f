"""Cutting of texts into sentence-aligned chunks under a token budget."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config
from tidemark.functions.text import closes_sentence, list_slices, sentences, strip, word_count, words


def windows(text: Column, budget: int) -> Column:
    """Windows of budget - 2 tokens; none of a text without words."""
    size = max(1, budget - 2)
    w = words(text)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w), F.lit(1)), F.lit(size)), lambda i: F.array_join(F.slice(w, i, size), " "))
    return F.when(F.size(w) > 0, cut).otherwise(F.array().cast("array<string>"))


#: White space as the column functions take it.
_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_PAUSE = re.compile(r"(?<=[;,|])[ \t-\r]+")


def count_words(texts: list[str]) -> list[int]:
    return [len([w for w in _SPACE.split(t) if w]) for t in texts]


def _windows(text: str, budget: int, count) -> list[str]:
    """Windows of budget - 2 words, halved while they hold more tokens than the budget."""
    w = [x for x in _SPACE.split(text) if x]
    size = max(1, budget - 2)
    todo, out = [w[k : k + size] for k in range(0, max(1, len(w)), size)][::-1], []
    while todo:
        part = todo.pop()
        if len(part) > 1 and count([" ".join(part)])[0] > budget:
            todo += [part[len(part) // 2 :], part[: len(part) // 2]]
        else:
            out.append(" ".join(part))
    return out


def pack_units(units: list[str], budget: int, carry: int, long_units: bool, count) -> list[tuple[str, int]]:
    """pack() of one list; count gives the tokens of each of some texts."""
    out: list[tuple[str, int]] = []
    held: list[tuple[str, int]] = []
    n = 0

    def close():
        out.append((" ".join(u for u, _ in held), n))

    for unit, size in zip(units, count(units)):
        if long_units and size > budget:
            if held:
                close()
            parts = _PAUSE.split(unit)
            parts = [x for p, k in zip(parts, count(parts)) for x in (_windows(p, budget, count) if k > budget else [p])]
            packed = [t for t, _ in pack_units(parts, budget, 0, False, count)]
            out += zip(packed, count(packed))
            held, n = [], 0
            continue
        if held and n + size > budget:
            close()
            back, n = [], 0
            for u in reversed(held):
                if n + u[1] > carry:
                    break
                back.append(u)
                n += u[1]
            held = back[::-1] if carry else []
            n = n if carry else 0
        held.append((unit, size))
        n += size
    if held:
        close()
    return out


_ARROW = pa.list_(pa.struct([("texto", pa.string()), ("tokens", pa.int32())]))
_CHUNKS = T.ArrayType(T.StructType([T.StructField("texto", T.StringType()), T.StructField("tokens", T.IntegerType())]))


def pack(units: Column, budget: int, overlap: float = config.CHUNK_OVERLAP, long_units: bool = True, tokens=None) -> Column:
    """Array of structs (texto, tokens): units joined while their tokens fit; each chunk begins with the whole units at
    the end of the one before that hold at most budget * overlap tokens. A unit over the budget closes the chunk and
    becomes chunks of its own (cut after ; , or |, packed greedily, what is still too long by windows), and the next one
    begins with nothing. tokens: a function without arguments that gives a function from texts to their numbers of
    tokens, called once a task; words are counted where there is none. One pass over the units, in slices of Arrow batches."""
    carry = int(budget * overlap)

    @F.arrow_udf(_CHUNKS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = tokens() if tokens else count_words
        for lists in batches:
            made = []
            for some in list_slices(lists):
                rows = [None if u is None else [{"texto": t, "tokens": k} for t, k in pack_units(u, budget, carry, long_units, count)] for u in some.to_pylist()]
                made.append(pa.array(rows, _ARROW))
            yield pa.concat_arrays(made)

    return run(units)


def tabular_cut(text: Column, budget: int, chunks: int = config.TABULAR_CHUNKS) -> Column:
    """The beginning of a long table: enough characters for the chunks that are kept, back to the last empty line."""
    most = int(chunks * budget * 4 * 1.5)
    head = F.left(text, F.lit(most))
    gap = F.locate("\n\n", F.reverse(head))
    return F.when(F.length(text) <= most, text).when(gap > 0, F.left(head, F.length(head) - gap - 1)).otherwise(head)


def chunk(docs: DataFrame, budget: int = config.CHUNK_TOKENS, overlap: float = config.CHUNK_OVERLAP, least: int = config.MIN_CHUNK_TOKENS, tabular: int = config.TABULAR_CHUNKS, tokens=None) -> DataFrame:
    """docs (doc_id, formato, texto, ...) to chunks: chunk_id, doc_id, posicion, num_tokens, texto.

    Sentences over the budget are split; chunks under `least` tokens are dropped; tables give at most `tabular` chunks;
    positions count from 0 after that. Where docs has a column idioma, its rules part the sentences. tokens: see pack().
    """
    table = F.col("formato").isin("csv", "xlsx")
    text = F.when(table, tabular_cut(F.col("texto"), budget, tabular)).otherwise(F.col("texto"))
    again = lambda c: F.transform(windows(c["texto"], budget), lambda p: F.struct(p.alias("texto"), word_count(p).cast("int").alias("tokens")))
    # what the overlap has carried over the budget is cut
    lang = F.col("idioma") if "idioma" in docs.columns else None
    docs = docs.withColumn("_p", pack(sentences(text, lang), budget, overlap, tokens=tokens))
    fitting = F.flatten(F.transform("_p", lambda c: F.when(c["tokens"] > budget, again(c)).otherwise(F.array(c))))
    rows = docs.withColumn("_c", F.filter(fitting, lambda c: c["tokens"] >= least))
    rows = rows.withColumn("_c", F.when(table, F.slice("_c", 1, tabular)).otherwise(F.col("_c")))
    rest = [c for c in docs.columns if c not in ("texto", "doc_id", "_p")]
    rows = rows.select("doc_id", *rest, F.posexplode("_c").alias("posicion", "c"))
    return rows.select(
        F.format_string("%s-chunk-%04d", F.col("doc_id").cast("string"), "posicion").alias("chunk_id"), "doc_id", *rest, "posicion",
        F.col("c.tokens").alias("num_tokens"), F.col("c.texto").alias("texto"),
    )


def over_budget(chunks: DataFrame, budget: int = config.CHUNK_TOKENS) -> DataFrame:
    """Chunks of at least 90 % of the budget whose joined text is over it, cut into windows; the others as they are."""
    again = (F.col("num_tokens") >= 0.9 * budget) & (word_count(F.col("texto")) > budget)
    parts = F.when(again, windows(F.col("texto"), budget)).otherwise(F.array("texto"))
    rows = chunks.select("doc_id", "posicion", F.posexplode(parts).alias("parte", "texto"))
    return rows.withColumn("num_tokens", word_count(F.col("texto")))


def align_sections(sections: Column) -> Column:
    """Sections (titulo, texto) where one that doesn't end a sentence gives its last sentence to the next, in turn."""
    kind = "struct<titulo: string, texto: string>"
    start = F.struct(F.array().cast(f"array<{kind}>").alias("out"), F.lit("").alias("carry"))

    def add(st: Column, s: Column) -> Column:
        text = strip(F.concat(st["carry"], F.lit(" "), s["texto"]))
        parts = sentences(text)
        open_end = ~closes_sentence(text) & (F.size(parts) > 0)
        kept = F.when(open_end, F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), " ")).otherwise(text)
        moved = F.when(open_end, F.element_at(parts, -1)).otherwise("")
        return F.struct(F.array_append(st["out"], F.struct(s["titulo"].alias("titulo"), kept.alias("texto"))).alias("out"), moved.alias("carry"))

    def close(st: Column) -> Column:
        last = F.element_at(st["out"], -1)
        whole = F.struct(last["titulo"].alias("titulo"), strip(F.concat(last["texto"], F.lit(" "), st["carry"])).alias("texto"))
        return F.when((st["carry"] == "") | (F.size(st["out"]) == 0), st["out"]).otherwise(
            F.array_append(F.slice(st["out"], 1, F.greatest(F.size(st["out"]) - 1, F.lit(0))), whole)
        )

    return F.filter(F.aggregate(sections, start, add, close), lambda s: s["texto"] != "")


def merge_sections(sections: Column, least: int = 60) -> Column:
    """Small sections joined until they hold enough tokens, under the first title; a small rest joins the one before."""
    kind = "struct<titulo: string, texto: string, tokens: int>"
    start = F.struct(F.array().alias("out"), F.lit(None).alias("cur")).cast(f"struct<out: array<{kind}>, cur: {kind}>")
    glue = lambda a, b: F.struct(a["titulo"].alias("titulo"), F.concat(a["texto"], F.lit("\n"), b["texto"]).alias("texto"), (a["tokens"] + b["tokens"]).alias("tokens"))

    def add(st: Column, s: Column) -> Column:
        one = F.struct(s["titulo"].alias("titulo"), s["texto"].alias("texto"), word_count(s["texto"]).cast("int").alias("tokens"))
        cur = F.when(st["cur"].isNull(), one).otherwise(glue(st["cur"], one))
        full = cur["tokens"] >= least
        return F.struct(F.when(full, F.array_append(st["out"], cur)).otherwise(st["out"]).alias("out"), F.when(~full, cur).alias("cur"))

    def close(st: Column) -> Column:
        n = F.size(st["out"])
        joined = F.array_append(F.slice(st["out"], 1, F.greatest(n - 1, F.lit(0))), glue(F.element_at(st["out"], -1), st["cur"]))
        return F.when(st["cur"].isNull(), st["out"]).when(n == 0, F.array(st["cur"])).otherwise(joined)

    return F.aggregate(sections, start, add, close)


def headings(lines: DataFrame) -> DataFrame:
    """lines (doc_id, linea, texto, tamano, negrita) with es_encabezado: short, with a letter, no closing mark, and larger
    than the body or bold after a closed line. The body size is the one with the most characters."""
    body = lines.groupBy("doc_id", "tamano").agg(F.sum(F.length("texto")).alias("_n"))
    body = body.groupBy("doc_id").agg(F.max_by("tamano", F.struct("_n", -F.col("tamano"))).alias("cuerpo"))
    before = F.lag("texto").over(Window.partitionBy("doc_id").orderBy("linea"))
    shape = (F.length("texto") <= 140) & ~F.col("texto").rlike(r"[.;,]$") & F.col("texto").rlike(r"\p{L}")
    large = F.col("tamano") > 1.15 * F.col("cuerpo")
    bold = F.col("negrita") & (F.col("tamano") >= F.col("cuerpo")) & (before.isNull() | closes_sentence(before))
    return lines.join(body, "doc_id").withColumn("es_encabezado", F.coalesce(shape & (large | bold), F.lit(False)))


def sections_of(lines: DataFrame) -> DataFrame:
    """(doc_id, seccion, titulo, nivel, texto) of documents with two headings or more; what comes first is level 0."""
    order = Window.partitionBy("doc_id").orderBy("linea")
    marked = headings(lines).withColumn("seccion", F.sum(F.col("es_encabezado").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    marked = marked.withColumn("_h", F.max("seccion").over(Window.partitionBy("doc_id"))).filter("_h >= 2")
    sizes = marked.filter("es_encabezado").select("doc_id", "tamano").distinct()
    sizes = sizes.withColumn("nivel", F.dense_rank().over(Window.partitionBy("doc_id").orderBy(F.desc("tamano"))))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("linea", "texto"))), lambda x: x["texto"]), "\n")
    head = F.max(F.when(F.col("es_encabezado"), F.col("texto"))).alias("titulo")
    out = marked.groupBy("doc_id", "seccion").agg(head, F.max(F.when(F.col("es_encabezado"), F.col("tamano"))).alias("tamano"), text.alias("texto"))
    return out.join(sizes, ["doc_id", "tamano"], "left").select("doc_id", "seccion", "titulo", F.coalesce("nivel", F.lit(0)).alias("nivel"), "texto")


def status(error: Column, needs_ocr: Column, text: Column, cleaned: Column, chunks: Column) -> Column:
    return (
        F.when(error.isNotNull(), "error_extraccion").when(needs_ocr, "pendiente_ocr").when(strip(text) == "", "vacio")
        .when(strip(cleaned) == "", "vacio_tras_limpieza").when(chunks == 0, "sin_fragmentos").otherwise("ok")
    )


def chunk_sections(docs: DataFrame, budget: int = config.CHUNK_TOKENS, overlap: float = config.CHUNK_OVERLAP, least: int = config.MIN_CHUNK_TOKENS, whole: int = 650, small: int = 60) -> DataFrame:
    """docs (doc_id, formato, texto, secciones) to chunks that follow sections: aligned to sentences, small ones joined,
    those of up to `whole` tokens kept whole, others packed; each chunk has its section's title. Documents without
    sections are cut as a whole."""
    flat = chunk(docs.filter(F.coalesce(F.size("secciones"), F.lit(0)) <= 0).drop("secciones"), budget, overlap, least).withColumn("titulo", F.lit(None).cast("string"))
    rows = docs.filter(F.size("secciones") > 0).select("doc_id", "formato", F.posexplode(merge_sections(align_sections(F.col("secciones")), small)).alias("s", "x"))
    parts = F.when(F.col("x.tokens") <= whole, F.array(F.struct(F.col("x.texto").alias("texto"), F.col("x.tokens").cast("int").alias("tokens")))).otherwise(pack(sentences(F.col("x.texto")), budget, overlap))
    rows = rows.select("doc_id", "formato", "s", F.col("x.titulo").alias("titulo"), F.posexplode(F.filter(parts, lambda c: c["tokens"] >= least)).alias("p", "c"))
    pos = F.row_number().over(Window.partitionBy("doc_id").orderBy("s", "p")) - 1
    rows = rows.withColumn("posicion", pos).select(
        F.format_string("%s-chunk-%04d", F.col("doc_id").cast("string"), "posicion").alias("chunk_id"), "doc_id", "formato", "posicion",
        F.col("c.tokens").alias("num_tokens"), F.col("c.texto").alias("texto"), "titulo",
    )
    return flat.unionByName(rows)
