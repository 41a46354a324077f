"""Line deduplication with levelled sorted runs of line hashes.

Lines are known by a 128-bit hash of their key. Documents are taken in batches by descending id. Every batch adds up
its keys (documents, largest holder), merge-anti-joins them with the runs written so far - a key that no run holds is
new and its holder in this batch is the line's keeper - and writes a sorted run of its own. When a level has FANOUT
runs they are merged into one run of the next level. The runs are tables that outlive the job: LineRuns.open() takes up
what state() told, and goes on. Spark's merge joins order the runs once more, as it doesn't know that files are sorted;
a run holds each key once, so that costs less than the batch itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import Workspace, only

#: Runs of one level that are merged into a run of the next.
FANOUT = 2
#: Batches of a whole table. Each is one more pass over the runs; at any size the table is dealt into as many.
BATCHES = 3
MIN_CHARS = 20
MIN_DOCS = 3

#: White space that is stripped from both ends of a line: space and U+0009 to U+000D.
_STRIP = " \t\n\u000b\f\r"
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.trim(line, F.lit(_STRIP)), _UPPER, _SMALL)


def key_hash(key: Column) -> Column:
    """128 bits in two numbers."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), F.reverse(key)).alias("h2"))


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row for each distinct key of a row: id, h1, h2; keys of under min_chars code points are left out."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    keys = F.array_distinct(F.transform(F.filter(F.transform(lines, line_key), lambda k: F.length(k) >= min_chars), key_hash))
    return only(docs, id_col, text_col).select(id_col, F.explode(keys).alias("k")).select(id_col, "k.h1", "k.h2")


class LineRuns:
    """The levelled runs: tables (h1, h2, n_docs, keeper) sorted by hash, at most FANOUT - 1 at a level at rest."""

    def __init__(self, ws: Workspace, fanout: int = FANOUT):
        self.ws, self.fanout = ws, fanout
        self.levels: list[list[DataFrame]] = []

    def state(self) -> list[tuple[int, str]]:
        """(level, folder) of every run, oldest first."""
        return [(level, run._workspace_path) for level, runs in enumerate(self.levels) for run in runs]

    @classmethod
    def open(cls, ws: Workspace, state: list[tuple[int, str]], fanout: int = FANOUT) -> LineRuns:
        """A store that holds the runs of an earlier one; new runs go to ws."""
        store = cls(ws, fanout)
        for level, path in state:
            while len(store.levels) <= level:
                store.levels.append([])
            store.levels[level].append(ws.read(path))
        return store

    def runs(self) -> DataFrame | None:
        """All runs as one table; a key has a row in each run that holds it."""
        out = None
        for run in (r for level in self.levels for r in level):
            out = run if out is None else out.unionByName(run)
        return out

    def merged(self) -> DataFrame:
        """One row for each key."""
        runs = self.runs()
        return runs.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def add(self, keys: DataFrame, id_col: str) -> None:
        """Take in the keys of a batch, whose ids are all below those of earlier batches."""
        batch = keys.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max(id_col).alias("_last"))
        runs = self.runs()
        if runs is None:
            new = batch.withColumnRenamed("_last", "keeper")
        else:
            # The anti-join with a flag for both outcomes: keys that a run holds have their keeper there.
            held = runs.filter(F.col("keeper").isNotNull()).select("h1", "h2", F.lit(True).alias("_held"))
            new = batch.join(held, ["h1", "h2"], "left").select(
                "h1", "h2", "n_docs", F.when(F.col("_held").isNull(), F.col("_last")).alias("keeper")
            )
        self._write(new, 0)

    def _write(self, rows: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self.ws.save(rows.sortWithinPartitions("h1", "h2"), f"run-{level}"))
        if len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            both = old[0]
            for run in old[1:]:
                both = both.unionByName(run)
            merged = both.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))
            self.levels[level] = []
            self._write(merged, level + 1)
            self.ws.drop(*old)


def batch_bounds(docs: DataFrame, id_col: str, batches: int) -> list[int]:
    """Ids that part the table into about equal batches (batches - 1 numbers, from one approximate aggregate)."""
    shares = [k / batches for k in range(1, batches)]
    got = docs.agg(F.percentile_approx(id_col, F.lit(shares), F.lit(1000)).alias("p")).first()["p"] if shares else []
    return sorted(set(got or []))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    batches: int = BATCHES, fanout: int = FANOUT,
) -> DataFrame:
    """Add n_lines, n_dropped and kept_text to every row.

    A key of at least min_chars code points that at least min_docs rows hold loses all its lines but those of the row
    with the largest id. Null or empty text: one empty line, kept as empty text. Rows that repeat an id count one by
    one as holders, and all rows of the largest id keep the line. Ids are numbers. Rows with a null id never hold or
    lose a line. Other
    columns stay as they are; those named n_lines, n_dropped or kept_text are replaced. An empty table gives no rows.
    """
    ws = Workspace(docs.sparkSession, "lines")
    rows = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"), F.struct("*").alias("_row"))
    ids = rows.filter(F.col("_id").isNotNull())
    keys = ws.save(line_keys(ids, "_id", "_text", min_chars), "keys")
    bounds = batch_bounds(ids.select("_id"), "_id", batches)
    store = LineRuns(ws, fanout)
    edges = [None, *bounds, None]
    for low, high in list(zip(edges[:-1], edges[1:]))[::-1]:
        batch = keys
        if low is not None:
            batch = batch.filter(F.col("_id") > low)
        if high is not None:
            batch = batch.filter(F.col("_id") <= high)
        store.add(batch, "_id")
    # written first, so that the join below has exchanges of its own that can be split where a line is very common
    repeated = ws.save(store.merged().filter(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper"), "repeated")
    lost = keys.join(repeated, ["h1", "h2"]).filter(F.col("_id") < F.col("keeper"))
    lost = lost.select("_id", F.struct("h1", "h2").alias("k")).groupBy("_id").agg(F.collect_set("k").alias("_lost"))
    lines = F.split(F.coalesce(F.col("_text"), F.lit("")), "\n", -1)
    stays = F.filter(
        lines, lambda x: ~((F.length(line_key(x)) >= min_chars) & F.array_contains(F.col("_lost"), key_hash(line_key(x))))
    )
    kept = rows.join(lost, "_id", "left").withColumn("_stays", F.when(F.col("_lost").isNull(), lines).otherwise(stays))
    n_lines = F.size(lines).cast("long")
    made = {"n_lines": n_lines, "n_dropped": n_lines - F.size("_stays"), "kept_text": F.array_join("_stays", "\n")}
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in made], *[v.alias(k) for k, v in made.items()])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query: line deduplication of all documents, with the digest of what stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, coalesce(k.doc_id < r.keeper, false) AS dropped FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
