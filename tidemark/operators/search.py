"""Exact vector search.

Every task keeps only the k best of its own rows for each query, so what is shuffled is at most k rows per query and
task. Queries are taken to the tasks in blocks of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config

#: Query vectors that are brought to the tasks at once.
QUERY_BLOCK = 4096
#: Similarities that a task holds at once: rows of a batch by queries.
CELLS = 1 << 21


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """v over its length; v itself where the length is below 1e-9."""
    n = norm(v)
    return F.when(n < 1e-9, v).otherwise(F.transform(v, lambda x: x / n))


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _best(q: np.ndarray, ids: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k largest of each query, ties by id."""
    order = np.lexsort((ids, -sims, q))
    q, ids, sims = q[order], ids[order], sims[order]
    head = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    place = np.arange(len(q)) - np.repeat(head, np.diff(np.r_[head, len(q)]))
    keep = place < k
    return q[keep], ids[keep], sims[keep]


def _searcher(ids: np.ndarray, vectors: np.ndarray, k: int):
    """The k best rows of a task for each query. A batch is taken in pieces of at most CELLS similarities (k rows at least),
    and a row enters only where it reaches the k-th best found so far."""

    def run(batches):
        q, found, best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        least, piece = np.full(len(ids), -np.inf), max(k, CELLS // max(len(ids), 1), 1)
        for batch in batches:
            for at in range(0, batch.num_rows, piece):
                part = batch.slice(at, piece)
                rows = part.column(0).to_numpy()
                sims = _matrix(part.column(1)) @ vectors.T
                np.round(sims, config.TAU_DIGITS, out=sims)
                n = len(rows)
                if n > k and np.isneginf(least).any():
                    np.maximum(least, np.partition(sims, n - k, axis=0)[n - k], out=least)
                r, c = np.nonzero(sims >= least)
                q, found, best = _best(np.concatenate([q, c]), np.concatenate([found, rows[r]]), np.concatenate([best, sims[r, c]]), k)
                full = np.flatnonzero(np.bincount(q, minlength=len(ids)) == k)
                # rows of one query are together, best first
                least[full] = best[np.searchsorted(q, full) + k - 1]
        if len(q):
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(found), pa.array(best)], ["query_id", "chunk_id", "sim"])

    return run


def top_k(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, chunk_id, sim, rank): the k largest inner products of each query, ties by chunk_id.

    index has chunk_id and vector, queries query_id and vector; both hold arrays of double of one length.
    """
    out = None
    held = queries.select("query_id", "vector")
    blocks = max(1, -(-held.count() // QUERY_BLOCK))
    for at in range(blocks):
        rows = held.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == at).collect()
        ids, vectors = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64)
        found = index.select("chunk_id", "vector").mapInArrow(_searcher(ids, vectors, k), "query_id long, chunk_id long, sim double")
        out = found if out is None else out.unionByName(found)
    best = Window.partitionBy("query_id").orderBy(F.desc("sim"), "chunk_id")
    return out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


#: Vectors of one block when all keys are compared with all.
KEY_BLOCK = 2048


def _similar(threshold: float):
    """Rows (u, v, id, vector, own) of two blocks, sorted by (u, v): pairs across them that reach the threshold."""

    def pairs(table: pa.Table) -> pa.RecordBatch:
        ids, own = table.column(2).to_numpy(), table.column(4).to_numpy(zero_copy_only=False).astype(bool)
        m = _matrix(table.column(3).combine_chunks())
        a, b = np.flatnonzero(own), np.flatnonzero(~own)
        sims = np.round(m[a] @ m[b].T, config.TAU_DIGITS) if len(a) and len(b) else np.zeros((len(a), len(b)))
        i, j = np.nonzero((sims >= threshold) & (ids[a][:, None] != ids[b]))
        return pa.RecordBatch.from_arrays([pa.array(ids[a[i]]), pa.array(ids[b[j]]), pa.array(sims[i, j])], ["a", "b", "sim"])

    return _by_pair(pairs)


def _by_pair(pairs):
    """A function of batches that gives pairs() the rows of each (u, v)."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(k).to_numpy() for k in (0, 1)], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if held and (key[lo] != last).any():
                    yield pairs(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(lo, hi - lo))
                last = key[lo]
        if held:
            yield pairs(pa.Table.from_batches(held))

    return run


def all_similar(vectors: DataFrame, threshold: float) -> DataFrame:
    """(a, b, sim) of all pairs of different keys with at least this inner product, in both directions.

    vectors: chunk_id, vector. Blocks against blocks on the executors; nothing goes through the driver.
    """
    spark = vectors.sparkSession
    blocks = max(1, -(-vectors.count() // KEY_BLOCK))
    block = F.pmod(F.xxhash64("chunk_id"), F.lit(blocks))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    rows = vectors.select(block.alias("u"), every.alias("v"), "chunk_id", "vector", F.lit(True).alias("own"))
    rows = rows.unionByName(vectors.select(every.alias("u"), block.alias("v"), "chunk_id", "vector", F.lit(False).alias("own")))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks * blocks // 4)
    return rows.repartition(tasks, "u", "v").sortWithinPartitions("u", "v").mapInArrow(_similar(threshold), "a long, b long, sim double")


#: Vectors of one block where only components are asked for: the least, and the most that a task holds twice. Between them
#: there are FOREST_BLOCKS blocks, so copies of vectors grow as the input.
FOREST_BLOCK, FOREST_MOST, FOREST_BLOCKS = 16384, 131072, 24


def _forest(threshold: float):
    """Rows (u, v, id, vector, own) of two blocks, sorted by (u, v): each key that is linked with another one of the two
    blocks, with the smallest key it is linked with, directly or over others."""

    def pairs(table: pa.Table) -> pa.RecordBatch:
        ids, own = table.column(2).to_numpy(), table.column(4).to_numpy(zero_copy_only=False).astype(bool)
        m = _matrix(table.column(3).combine_chunks())
        keys, node = np.unique(ids, return_inverse=True)
        a, b, na, nb = m[own], m[~own], node[own], node[~own]
        root = np.arange(len(keys))
        piece = max(1, 2 * CELLS // max(len(b), 1))
        for at in range(0, len(a), piece):
            sims = a[at : at + piece] @ b.T
            i, j = np.nonzero(sims >= threshold - 1e-8)
            keep = np.round(sims[i, j], config.TAU_DIGITS) >= threshold
            i, j = na[at + i[keep]], nb[j[keep]]
            while True:
                x, y = root[i], root[j]
                apart = x != y
                if not apart.any():
                    break
                i, j, x, y = i[apart], j[apart], x[apart], y[apart]
                # each larger root gets one smaller one, so there is no ring; then all go to the end of their chains
                root[np.maximum(x, y)] = np.minimum(x, y)
                while (root[root] != root).any():
                    root = root[root]
        linked = np.flatnonzero(root != np.arange(len(keys)))
        return pa.RecordBatch.from_arrays([pa.array(keys[linked]), pa.array(keys[root[linked]])], ["a", "b"])

    return _by_pair(pairs)


def similar_forest(vectors: DataFrame, threshold: float) -> DataFrame:
    """(a, b) with the same components as all pairs of different keys with at least this inner product.

    Each two blocks are compared once and give at most a row for each of their keys, so neither the pairs nor many copies
    of the vectors are shuffled: of each vector one copy for each block, and one more.
    """
    spark, n = vectors.sparkSession, vectors.count()
    blocks = max(1, min(-(-n // FOREST_BLOCK), FOREST_BLOCKS), -(-n // FOREST_MOST))
    block = F.pmod(F.xxhash64("chunk_id"), F.lit(blocks))
    upto = lambda lo, hi: F.explode(F.sequence(lo, hi))
    first, last = F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")
    rows = vectors.select(block.alias("u"), upto(block, last).alias("v"), "chunk_id", "vector", F.lit(True).alias("own"))
    rows = rows.unionByName(vectors.select(upto(first, block).alias("u"), block.alias("v"), "chunk_id", "vector", F.lit(False).alias("own")))
    every = blocks * (blocks + 1) // 2
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(4 * every, 1000), every // 4)
    return rows.repartition(tasks, "u", "v").sortWithinPartitions("u", "v").mapInArrow(_forest(threshold), "a long, b long")


def search_all(indices: dict[str, DataFrame], queries: dict[str, DataFrame], k: int = config.CANDIDATES) -> DataFrame:
    """The rankings table over several indices: query_id, encoder, enc_ord, rank, chunk_id, sim."""
    out = None
    for order, (name, index) in enumerate(indices.items(), 1):
        one = top_k(index, queries[name], k).select("query_id", F.lit(name).alias("encoder"), F.lit(order).alias("enc_ord"), "rank", "chunk_id", "sim")
        out = one if out is None else out.unionByName(one)
    return out


def fetch(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Vectors of wanted (ord, chunk_id), with their order."""
    return wanted.join(index.select("chunk_id", "vector"), "chunk_id").select("ord", "chunk_id", "vector")


def feedback(queries: DataFrame, index: DataFrame, ranking: DataFrame, k: int, alpha: float = 1.0, beta: float = 0.3) -> DataFrame:
    """Queries moved towards the mean of their k best vectors, at unit length; unchanged for beta 0 or an empty ranking."""
    near = ranking.filter(F.col("rank") <= k).join(index, "chunk_id")
    mean = near.select("query_id", F.posexplode("vector")).groupBy("query_id", "pos").agg(F.avg("col").alias("m"))
    mean = mean.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("_mean"))
    moved = F.zip_with("vector", F.col("_mean")["m"], lambda x, m: alpha * x + beta * m)
    use = F.col("_mean").isNotNull() & F.lit(beta != 0)
    return queries.join(mean, "query_id", "left").select(
        *[c for c in queries.columns if c != "vector"], F.when(use, unit(moved)).otherwise(F.col("vector")).alias("vector")
    )


def off_unit(index: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Rows whose vector isn't of unit length."""
    return index.select("chunk_id", norm(F.col("vector")).alias("norm")).filter(F.abs(F.col("norm") - 1) > tolerance)


def check_dimension(index: DataFrame, dim: int) -> DataFrame:
    """The index; reading it fails if a vector has another dimension."""
    ok = F.assert_true(F.size("vector") == dim, F.lit("vector of another dimension"))
    return index.withColumn("_ok", ok).filter(F.col("_ok").isNull()).drop("_ok")


def parity(a: DataFrame, b: DataFrame, threshold: float = 0.999) -> DataFrame:
    """Smallest cosine between equal ids of two indices, and whether it reaches the threshold."""
    both = a.select("chunk_id", "vector").join(b.select("chunk_id", F.col("vector").alias("other")), "chunk_id")
    low = F.min(F.round(dot(F.col("vector"), F.col("other")) / (norm(F.col("vector")) * norm(F.col("other"))), 6))
    return both.agg(low.alias("min_cosine")).withColumn("same", F.col("min_cosine") >= threshold)


def with_block(rows: DataFrame, pos: str, size: int = config.BLOCK_ROWS) -> DataFrame:
    return rows.withColumn("block", F.floor(F.col(pos) / size).cast("long"))


def share(a: float, b: float) -> tuple[float, float]:
    """Checked percentages of a share of blocks."""
    if not 0 <= a < b <= 100:
        raise ValueError("a share is two percentages, 0 <= a < b <= 100")
    return a, b


def blocks_of_share(rows: DataFrame, total: int, a: float, b: float) -> DataFrame:
    """Rows whose block lies in the share; shares that meet at their ends part the blocks."""
    share(a, b)
    return rows.filter((F.col("block") >= int(total * a / 100)) & (F.col("block") < int(total * b / 100)))


def missing_blocks(done: DataFrame, total: int) -> DataFrame:
    return done.sparkSession.range(total).select(F.col("id").alias("block")).join(done.select("block").distinct(), "block", "left_anti")


def fingerprint(rows: DataFrame, *columns: str) -> DataFrame:
    """A number of the content that doesn't depend on the order of rows, and the count of rows."""
    sums = [F.sum(F.pmod(F.xxhash64(*columns, F.lit(k)), F.lit(1 << 40))) for k in (0, 1)]
    return rows.agg(F.xxhash64(*sums).alias("print"), F.count(F.lit(1)).alias("rows"))


def encode(rows: DataFrame, id_col: str, text_col: str, load, prefix: str = "") -> DataFrame:
    """(id_col, vector): unit vectors of prefixed texts. load() gives a function from a list of texts to a matrix; it is
    called once per task. Models aren't part of this library."""

    def run(batches):
        model = load()
        for batch in batches:
            if batch.num_rows:
                m = np.asarray(model([prefix + (t or "") for t in batch.column(1).to_pylist()]), np.float64)
                m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(m), pa.list_(pa.float64()))], [id_col, "vector"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, vector array<double>")
