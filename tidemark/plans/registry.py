"""Registry of named queries over the test tables, each with DuckDB SQL for the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_WHOLE = ("int", "smallint", "tinyint")


def query(name: str, sql: str | None = None):
    """Register a query; whole numbers of its result become bigint."""

    def keep(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(Tables(spark, sf_dir))
            return df.withColumns({c: F.col(c).cast("bigint") for c, kind in df.dtypes if kind in _WHOLE}) if any(k in _WHOLE for _, k in df.dtypes) else df

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return f

    return keep


class Tables:
    """The test tables, and the retrieval tables that are made of them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._ranked: DataFrame | None = None

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def chunks(self) -> DataFrame:
        """Every vector is a chunk: four to a document, forty sources; its text is that of the document of its number."""
        doc = F.floor(F.col("vec_id") / 4).cast("long")
        rows = self.embeddings.select(
            F.col("vec_id").alias("chunk_id"), doc.alias("doc_id"), F.concat(F.lit("s"), F.pmod(doc, F.lit(40))).alias("fuente"),
            (F.pmod("label", F.lit(3)) + 1).cast("long").alias("fenomeno"), F.col("label").cast("long").alias("label"),
        )
        texts = self.documents.select(F.col("doc_id").alias("chunk_id"), F.col("text").alias("texto"))
        return rows.join(texts, "chunk_id", "left")

    def indices(self) -> dict[str, DataFrame]:
        """Index a: the vectors; index b: their second halves at unit length."""
        from tidemark.operators.search import doubles, unit

        v = doubles(F.col("embedding"))
        base = self.embeddings
        return {
            "a": base.select(F.col("vec_id").alias("chunk_id"), v.alias("vector")),
            "b": base.select(F.col("vec_id").alias("chunk_id"), unit(F.slice(v, 33, 32)).alias("vector")),
        }

    def query_vectors(self) -> dict[str, DataFrame]:
        """The vectors whose id is divisible by 100 are queries, numbered in order."""
        number = F.floor(F.col("chunk_id") / 100).cast("long").alias("query_id")
        return {k: v.filter("chunk_id % 100 = 0").select(number, "vector") for k, v in self.indices().items()}

    def queries(self) -> DataFrame:
        rows = self.embeddings.filter("vec_id % 100 = 0")
        return rows.select(F.floor(F.col("vec_id") / 100).cast("long").alias("query_id"), (F.pmod("label", F.lit(3)) + 1).cast("long").alias("fenomeno"), F.col("label").cast("long").alias("label"))

    def rankings(self) -> DataFrame:
        """The 50 best of both indices for each query; searched once for each query that is run."""
        from tidemark.operators.search import search_all

        if self._ranked is None:
            self._ranked = search_all(self.indices(), self.query_vectors(), 50).persist()
        return self._ranked

    def named(self) -> DataFrame:
        return self.rankings().join(self.chunks(), "chunk_id")

    def qrels(self) -> DataFrame:
        """Grade 2 for chunks of the query's label, 1 for those of a neighbouring label."""
        near = F.explode(F.array(*[F.struct((F.col("label") + d).alias("label"), F.lit(2.0 - abs(d)).alias("grade")) for d in (-1, 0, 1)]))
        wanted = self.queries().select("query_id", near.alias("w")).select("query_id", "w.label", "w.grade")
        return self.chunks().join(wanted, "label").select("query_id", "chunk_id", "doc_id", "fuente", "grade")

    def relevant(self) -> DataFrame:
        """Sources with at least three chunks of grade 2."""
        return self.qrels().filter("grade = 2").groupBy("query_id", "fuente").agg(F.count(F.lit(1)).alias("n")).filter("n >= 3").select("query_id", "fuente")

    def candidates(self, mode: str = "rrf") -> DataFrame:
        """Fused and named candidates with the query's phenomenon."""
        from tidemark.operators.fusion import fuse

        rows = fuse(self.rankings(), mode).join(self.chunks(), "chunk_id")
        return rows.join(self.queries().select("query_id", F.col("fenomeno").alias("query_fenomeno")), "query_id")


#: The same retrieval tables in SQL.
BASE = """
WITH chunks AS (
  SELECT e.vec_id AS chunk_id, e.vec_id // 4 AS doc_id, 's' || ((e.vec_id // 4) % 40) AS fuente, (e.label % 3 + 1)::BIGINT AS fenomeno,
         e.label::BIGINT AS label, d.text AS texto, e.embedding::DOUBLE[] AS va, (e.embedding::DOUBLE[])[33:64] AS vb
  FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id
), queries AS (SELECT chunk_id // 100 AS query_id, fenomeno, label FROM chunks WHERE chunk_id % 100 = 0),
sims AS (
  SELECT q.chunk_id // 100 AS query_id, 'a' AS encoder, 1 AS enc_ord, c.chunk_id, round(list_dot_product(c.va, q.va), 9) AS sim
  FROM chunks q, chunks c WHERE q.chunk_id % 100 = 0
  UNION ALL
  SELECT q.chunk_id // 100, 'b', 2, c.chunk_id,
         round(list_dot_product(c.vb, q.vb) / (sqrt(list_dot_product(c.vb, c.vb)) * sqrt(list_dot_product(q.vb, q.vb))), 9)
  FROM chunks q, chunks c WHERE q.chunk_id % 100 = 0
), rankings AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, encoder ORDER BY sim DESC, chunk_id) AS rank FROM sims) WHERE rank <= 50
), qrels AS (
  SELECT q.query_id, c.chunk_id, c.doc_id, c.fuente, CASE WHEN q.label = c.label THEN 2.0 ELSE 1.0 END::DOUBLE AS grade
  FROM queries q, chunks c WHERE abs(q.label - c.label) <= 1
), relevant AS (SELECT query_id, fuente FROM qrels WHERE grade = 2 GROUP BY 1, 2 HAVING count(*) >= 3)
"""


def fused(value: str, total: str = "sum(value)", source: str = "rankings") -> str:
    """SQL of fused candidates: value is taken per ranking row, total per candidate."""
    return f"""
, valued AS (SELECT *, {value} AS value FROM {source}),
grouped AS (
  SELECT query_id, chunk_id, round({total}, 9) AS score, count(*) AS consensus, min(enc_ord * 1000 + rank) AS first FROM valued GROUP BY 1, 2
), candidates AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first) AS pos FROM grouped),
named AS (
  SELECT k.query_id, k.chunk_id, k.score, k.pos, c.doc_id, c.fuente, c.fenomeno, c.texto, q.fenomeno AS query_fenomeno
  FROM candidates k JOIN chunks c USING (chunk_id) JOIN queries q USING (query_id)
), raised AS (
  SELECT *, round(CASE WHEN fenomeno = query_fenomeno THEN score * 1.05 ELSE score END, 9) AS score2 FROM named
), boosted AS (SELECT * EXCLUDE (pos), row_number() OVER (PARTITION BY query_id ORDER BY score2 DESC, pos) AS pos FROM raised)
"""


RRF = fused("1.0::DOUBLE / (60 + rank)")
CONVEX = fused(
    "CASE WHEN max(sim) OVER w = min(sim) OVER w THEN 1.0 ELSE (sim - min(sim) OVER w) / (max(sim) OVER w - min(sim) OVER w) END",
).replace("FROM rankings)", "FROM rankings WINDOW w AS (PARTITION BY query_id, encoder))")

DISTINCT_TEXT = """
, keyed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, trim(regexp_replace(lower(texto), '\\s+', ' ', 'g')) ORDER BY pos) AS copy FROM boosted
), single AS (SELECT * EXCLUDE (pos, copy), row_number() OVER (PARTITION BY query_id ORDER BY pos) AS pos FROM keyed WHERE copy = 1)
"""


def spread(limit: int, source: str = "single", per_doc: int = 3) -> str:
    return f"""
, ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY pos) > {per_doc} AS late FROM {source}),
chosen AS (
  SELECT * FROM (SELECT * EXCLUDE (pos), row_number() OVER (PARTITION BY query_id ORDER BY late, pos) AS pos FROM ranked) WHERE pos <= {limit}
)
"""


def pooled(score: str, source: str = "boosted", top: int = 3) -> str:
    """SQL of documents: score over the list s of a source's scores, best first."""
    return f"""
, sources AS (
  SELECT query_id, fuente, list(score2 ORDER BY score2 DESC) AS s, count(*) AS n, arg_min(doc_id, pos) AS doc_id, min(pos) AS first FROM {source} GROUP BY 1, 2
), pooled AS (SELECT *, round({score} + n * 1e-9, 11) AS score FROM sources),
documents3 AS (
  SELECT query_id, rank, doc_id, fuente, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first) AS rank FROM pooled) WHERE rank <= {top}
)
"""


TOP2 = "list_sum(s[1:2]) / len(s[1:2])"


def sentence_list(text: str) -> str:
    """SQL of the sentences of a text."""
    split = rf"regexp_split_to_array(regexp_replace({text}, '([.!?…])[ \t\n\x0B\f\r]+(\S)', '\1' || chr(10) || '\2', 'g'), '\n+')"
    return f"list_filter(list_transform({split}, lambda x: trim(x)), lambda x: x <> '')"
