"""Readers of documents, queries, judgments and caches."""

from __future__ import annotations

import csv
import io
import json
import shutil
import subprocess

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config
from tidemark.functions.text import row_text, strip
from tidemark.sources.binary import row_line, tile_text, xlsx_text

# Keys of an article's body, in order, and of its metadata.
BODY_KEYS = ["body_paragraphs", "body_text", "sections", "content", "texto", "abstract"]
META_KEYS = ["alerta_meta", "fields", "lists"]


def catalogue(inventory: DataFrame, codes: DataFrame) -> DataFrame:
    """inventory (fila, fenomeno, observatorio, fuente) to doc_id `F1-CODE-001`: a running number per phenomenon and code.

    codes: observatorio, codigo. An observatory without a code makes the read fail; formula cells give no code.
    """
    known = codes.filter(~F.col("codigo").startswith("=")).select("observatorio", "codigo")
    # a row per observatory
    rows = inventory.join(F.broadcast(known), "observatorio", "left")
    checked = F.when(F.col("codigo").isNull(), F.raise_error(F.concat(F.lit("observatory without a code: "), "observatorio"))).otherwise(F.col("codigo"))
    rows = rows.withColumn("codigo", checked)
    n = F.row_number().over(Window.partitionBy("fenomeno", "codigo").orderBy("fila"))
    fmt = F.lower(F.regexp_extract("fuente", r"\.([^.]+)$", 1))
    return rows.withColumns({"doc_id": F.format_string("F%d-%s-%03d", F.col("fenomeno"), F.col("codigo"), n), "formato": fmt})


def catalogue_report(docs: DataFrame, present: DataFrame) -> DataFrame:
    """(medida, n): total, on disk, missing, repeated ids, repeated sources."""
    on_disk = docs.join(present.select("fuente").distinct(), "fuente", "left_semi")
    twice = lambda c: docs.groupBy(c).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = {"total": docs, "en_disco": on_disk, "doc_id_repetidos": twice("doc_id"), "fuentes_repetidas": twice("fuente")}
    out = None
    for name, df in parts.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("medida"), "n")
        out = row if out is None else out.unionByName(row)
    missing = docs.join(present.select("fuente").distinct(), "fuente", "left_anti").agg(F.count(F.lit(1)).alias("n"))
    return out.unionByName(missing.select(F.lit("ausentes").alias("medida"), "n"))


def flatten_value(value) -> str:
    """Scalars as text, lists by lines, objects as `key: value`, or the value alone if it is long."""
    if value is None:
        return ""
    if isinstance(value, list):
        return "\n".join(t for t in map(flatten_value, value) if t)
    if isinstance(value, dict):
        parts = ((k, flatten_value(v)) for k, v in value.items())
        return "\n".join(f"{k}: {t}" if len(t) < 200 else t for k, t in parts if t)
    return str(value)


@F.pandas_udf(T.StringType())
def flatten_json(text: pd.Series) -> pd.Series:
    return text.map(lambda t: flatten_value(json.loads(t)), na_action="ignore")


@F.pandas_udf(T.StructType([T.StructField("clase", T.StringType()), T.StructField("texto", T.StringType())]))
def json_document(text: pd.Series) -> pd.DataFrame:
    """A list is a catalogue of records, an object with a title or body an article; anything else is flattened."""

    def one(t):
        root = json.loads(t)
        if isinstance(root, list):
            return "catalogo", "\n\n".join(x for x in map(flatten_value, root) if x)
        if isinstance(root, dict) and any(k in root for k in ("title", "titulo", *BODY_KEYS)):
            body = next((b for b in (flatten_value(root.get(k)) for k in BODY_KEYS) if b), "")
            parts = [flatten_value(root.get("title") or root.get("titulo")), body, *[flatten_value(root.get(k)) for k in META_KEYS]]
            return "articulo", "\n\n".join(p for p in parts if p)
        return "plano", flatten_value(root)

    return pd.DataFrame([one(t) if t is not None else (None, None) for t in text], columns=["clase", "texto"])


def csv_rows(text: str) -> list[str]:
    """A block per row of CSV text with a header, like row_text(); quoted cells may hold line ends."""
    rows = list(csv.reader(io.StringIO(text)))
    return [b for b in (row_line(rows[0], row) for row in rows[1:]) if b]


@F.pandas_udf(T.ArrayType(T.StringType()))
def csv_texts(text: pd.Series) -> pd.Series:
    return text.map(csv_rows, na_action="ignore")


def csv_blocks(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """(texto): a block per row of CSV files with a header.

    Files are read whole, as UTF-8 or else Latin-1. With an encoding given, Spark splits large files among tasks.
    """
    if encoding:
        df = spark.read.csv(path, header=True, encoding=encoding, multiLine=False)
        return df.select(row_text(df.columns).alias("texto"))
    raw = spark.read.format("binaryFile").load(path)
    return raw.select(F.explode(csv_texts(decoded(F.col("content")))).alias("texto"))


def plain_text(spark: SparkSession, path: str) -> DataFrame:
    """(fuente, texto): a row per file, as UTF-8 or else Latin-1."""
    raw = spark.read.format("binaryFile").load(path)
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("fuente"), decoded(F.col("content")).alias("texto"))


def decoded(content: Column) -> Column:
    """Bytes as UTF-8 (a byte-order mark is dropped) where they are valid, else as Latin-1."""
    text = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))
    return F.regexp_replace(text, "^﻿", "")


def needs_ocr(text: Column) -> Column:
    return F.length(strip(F.coalesce(text, F.lit("")))) < config.OCR_MIN_CHARS


def image_document(df: DataFrame) -> DataFrame:
    """Images have no text of their own and wait for OCR."""
    return df.withColumns({"texto": F.lit(""), "necesita_ocr": F.lit(True)})


@F.pandas_udf(T.StructType([T.StructField("texto", T.StringType()), T.StructField("error", T.StringType())]))
def _binary_text(kind: pd.Series, content: pd.Series) -> pd.DataFrame:
    readers = {"xlsx": xlsx_text, "pbf": tile_text}

    def one(k, c):
        if k not in readers or c is None:
            return None, None
        try:
            return readers[k](bytes(c)), None
        except Exception as e:  # whatever a broken file does is its error
            return None, f"unreadable {k}: {e}"

    return pd.DataFrame([one(k, c) for k, c in zip(kind, content)], columns=["texto", "error"])


def dispatch(files: DataFrame) -> DataFrame:
    """files (fuente, content) to (fuente, formato, texto, necesita_ocr, error): by extension; errors are values."""
    fmt = F.lower(F.regexp_extract("fuente", r"\.([^.]+)$", 1))
    rows = files.withColumns({"formato": fmt, "_t": decoded(F.col("content"))}).withColumn("_b", _binary_text("formato", "content"))
    text = (
        F.when(F.col("formato") == "txt", F.col("_t"))
        .when(F.col("formato") == "csv", F.array_join(csv_texts(F.when(F.col("formato") == "csv", F.col("_t"))), "\n\n"))
        .when((F.col("formato") == "json") & F.try_parse_json("_t").isNotNull(), json_document(F.when((F.col("formato") == "json") & F.try_parse_json("_t").isNotNull(), F.col("_t")))["texto"])
        .when(F.col("formato").isin("xlsx", "pbf"), F.col("_b.texto"))
        .when(F.col("formato").isin("png", "jpg", "jpeg", "tif", "tiff"), "")
    )
    error = F.when((F.col("formato") == "json") & F.try_parse_json("_t").isNull(), "invalid json").when(F.col("_b.error").isNotNull(), F.col("_b.error"))
    error = error.when(text.isNull(), F.concat(F.lit("no reader for "), "formato"))
    rows = rows.withColumns({"texto": text, "error": error})
    return rows.select("fuente", "formato", "texto", (F.col("error").isNull() & needs_ocr(F.col("texto"))).alias("necesita_ocr"), "error")


class NotHere(RuntimeError):
    """A reader whose library isn't part of this package."""


def binary_reader(kind: str):
    """Readers of pdf and OCR engines: pass a function from bytes to text to extract_with() instead."""
    raise NotHere(f"{kind} needs a library that isn't installed; give extract_with() a function of your own")


def ocr_available(languages: list[str], command: str = "tesseract") -> tuple[bool, str]:
    """Whether an OCR command is installed with these languages, and what is wrong if not."""
    where = shutil.which(command)
    if not where:
        return False, f"{command} isn't installed"
    try:
        told = subprocess.run([where, "--list-langs"], capture_output=True, text=True, timeout=30, check=True).stdout
    except (OSError, subprocess.SubprocessError) as e:
        return False, f"{command} doesn't run: {e}"
    missing = sorted(set(languages) - set(told.split()))
    return not missing, f"languages missing: {', '.join(missing)}" if missing else where


def extract_with(files: DataFrame, extract) -> DataFrame:
    """(fuente, texto, error) by a function from bytes to text; what it raises becomes the error."""

    def run(batches):
        for pdf in batches:
            rows = []
            for name, content in zip(pdf["fuente"], pdf["content"]):
                try:
                    rows.append((name, extract(content), None))
                except Exception as e:  # an error of one file is a value, not the job's
                    rows.append((name, None, str(e)))
            yield pd.DataFrame(rows, columns=["fuente", "texto", "error"])

    return files.select("fuente", "content").mapInPandas(run, "fuente string, texto string, error string")


def pending_ocr(docs: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """Documents that wait for OCR and aren't in the cache, by id."""
    out = docs.filter("necesita_ocr")
    out = out if cache is None else out.join(cache.select("doc_id"), "doc_id", "left_anti")
    return out.select("doc_id").orderBy("doc_id")


def apply_ocr(docs: DataFrame, cache: DataFrame) -> DataFrame:
    """Documents with the cached OCR text in place of their own, no longer waiting."""
    rows = docs.join(cache.select("doc_id", F.col("texto").alias("_ocr")), "doc_id", "left")
    return rows.withColumns({"texto": F.coalesce("_ocr", "texto"), "necesita_ocr": F.col("necesita_ocr") & F.col("_ocr").isNull()}).drop("_ocr")


def queries_of_text(lines: DataFrame) -> DataFrame:
    """lines (n, linea) to (query_id, texto): an id `q001` opens a query that runs to the next one."""
    rows = lines.select("n", strip(F.col("linea")).alias("l")).filter("l <> ''")
    head = r"^([qQ]\d+)\b[\s.:)\-]*(.*)$"
    rows = rows.withColumns({"_id": F.nullif(F.regexp_extract("l", head, 1), F.lit("")), "_rest": F.regexp_extract("l", head, 2)})
    rows = rows.withColumn("_g", F.count("_id").over(Window.partitionBy(F.lit(1)).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)))
    said = F.when(F.col("_id").isNull(), F.col("l")).otherwise(F.nullif("_rest", F.lit("")))
    parts = rows.filter("_g > 0").groupBy("_g").agg(F.lower(F.max("_id")).alias("query_id"), F.array_sort(F.collect_list(F.when(said.isNotNull(), F.struct("n", said.alias("s"))))).alias("_p"))
    text = strip(F.regexp_replace(F.array_join(F.col("_p")["s"], " "), r"(?U)\s+", " "))
    return parts.select("query_id", text.alias("texto")).filter("texto <> ''")


def queries_of_json(rows: DataFrame) -> DataFrame:
    """Rows with query_id and texto, query or pregunta: the first that isn't empty."""
    cols = [F.nullif(F.trim(F.col(c)), F.lit("")) for c in ("texto", "query", "pregunta") if c in rows.columns]
    return rows.select(F.lower("query_id").alias("query_id"), F.coalesce(*cols).alias("texto")).filter("texto IS NOT NULL")


def load_index(vectors: DataFrame, meta: DataFrame) -> DataFrame:
    """Vectors with their metadata by position; fails if the two tables differ in size."""
    a, b = vectors.count(), meta.count()
    if a != b:
        raise ValueError(f"{a} vectors and {b} rows of metadata")
    return meta.join(vectors, "pos")


def require(wanted: list[str], available: list[str]) -> list[str]:
    """The wanted names, or all if none is named; an error if one is missing."""
    if missing := sorted(set(wanted or []) - set(available)):
        raise ValueError(f"missing: {', '.join(missing)}; there are {', '.join(sorted(available))}")
    return list(wanted or sorted(available))


def encoders_of(rankings: DataFrame) -> DataFrame:
    return rankings.select("encoder").distinct().orderBy("encoder")


def first_encoder(rows: DataFrame, *columns: str) -> DataFrame:
    """The columns of chunks as the index that sorts first has them: rows has encoder and chunk_id."""
    first = rows.agg(F.min("encoder").alias("encoder"))  # one row
    return rows.join(F.broadcast(first), "encoder").select("chunk_id", *columns).distinct()


def source_of_documents(chunks: DataFrame, last: bool = False) -> DataFrame:
    """(doc_id, fuente): the source of a document's first chunk (or last)."""
    pick = F.max_by if last else F.min_by
    return chunks.groupBy("doc_id").agg(pick("fuente", "chunk_id").alias("fuente"))


def judgments(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records (query_id, fragmentos map, documentos array) to the two tables of judgments."""
    frags = raw.select("query_id", F.explode("fragmentos").alias("chunk_id", "grade"))
    return frags, raw.select("query_id", F.explode("documentos").alias("doc_id")).distinct()


def ranking_rows(raw: DataFrame) -> DataFrame:
    """Records (query_id, rankings map of arrays) to rows (query_id, encoder, rank, chunk_id, sim)."""
    rows = raw.select("query_id", F.explode("rankings").alias("encoder", "_l")).select("query_id", "encoder", F.posexplode("_l").alias("rank", "r"))
    return rows.select("query_id", "encoder", (F.col("rank") + 1).alias("rank"), "r.chunk_id", "r.sim")


def mention_rows(raw: DataFrame) -> DataFrame:
    return raw.select("chunk_id", "doc_id", F.explode("menciones").alias("m")).select("chunk_id", "doc_id", "m.*")


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def judged_texts(raw: DataFrame) -> DataFrame:
    """(chunk_id, texto): the last text of each chunk, by ord."""
    return raw.groupBy("chunk_id").agg(F.max_by("texto", "ord").alias("texto"))


def first_fragments(fragments: DataFrame | None, index_meta: DataFrame, limit: int | None = None) -> DataFrame:
    """The stored fragments, or the metadata of the index where there are none; the first `limit` by chunk_id."""
    rows = index_meta if fragments is None else fragments
    return rows if limit is None else rows.orderBy("chunk_id").limit(limit)


def load_queries(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, texto) by id: JSON lines by the suffix .jsonl or .json, else text."""
    if path.endswith((".jsonl", ".json")):
        return queries_of_json(spark.read.json(path)).orderBy("query_id")
    if path.endswith(".pdf"):
        binary_reader("pdf")
    # a file of queries is small: it is read whole, so that its lines keep their numbers
    whole = spark.read.text(path, wholetext=True)
    lines = whole.select(F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("n", "linea"))
    return queries_of_text(lines).orderBy("query_id")


def recover(wanted: DataFrame, indexed: DataFrame, raw: DataFrame) -> DataFrame:
    """Metadata of wanted documents from the index or else from the raw texts; reading fails if one is in neither."""
    here = wanted.select("doc_id").distinct().join(indexed.select("doc_id", F.col("fuente").alias("_a")), "doc_id", "left")
    both = here.join(raw.select("doc_id", F.col("fuente").alias("_b")), "doc_id", "left")
    lost = F.raise_error(F.concat(F.lit("document without metadata: "), F.col("doc_id").cast("string"))).cast("string")
    return both.select("doc_id", F.coalesce("_a", "_b", lost).alias("fuente"), F.col("_a").isNotNull().alias("indexado"))
