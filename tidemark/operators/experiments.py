"""Grids of ranking policies, and the evaluation of many runs over one stored search."""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import config
from tidemark.operators import evaluation, fusion


def policies(spark: SparkSession, dims: dict[str, list]) -> DataFrame:
    """Product of the dimensions, with runs that differ only in a k0 they don't use kept once (the first)."""
    names = list(dims)
    rows = list(itertools.product(*dims.values()))
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], ["idx", *names])
    if not {"fusion", "k0"} <= set(names):
        return df
    key = [F.when(F.col("fusion") == "rrf", F.col("k0")) if n == "k0" else F.col(n) for n in names]
    first = Window.partitionBy(*key).orderBy("idx")
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def subsets(names: list[str], most: int) -> list[tuple[str, ...]]:
    """All combinations of one to `most` names, small ones first."""
    return [c for n in range(1, min(most, len(names)) + 1) for c in itertools.combinations(names, n)]


def encoder_subsets(encoders: DataFrame, most: int) -> DataFrame:
    """(subconjunto) for a table of names (encoder), by self-joins with a < b."""
    level = encoders.select(F.array("encoder").alias("subconjunto"))
    out = level
    for _ in range(most - 1):
        # one row per encoder: a handful
        level = level.join(F.broadcast(encoders), F.element_at("subconjunto", -1) < F.col("encoder")).select(F.array_append("subconjunto", F.col("encoder")).alias("subconjunto"))
        out = out.unionByName(level)
    return out


def grid_plan(spark: SparkSession, chunks: list[int], overlaps: list[float], encoders: list[str], most: int, dims: dict[str, list]) -> DataFrame:
    """Chunk sizes x overlaps x encoder subsets x policies."""
    cuts = spark.createDataFrame(list(itertools.product(chunks, overlaps)), "chunk int, solape double")
    groups = spark.createDataFrame([(list(s),) for s in subsets(encoders, most)], "encoders array<string>")
    # all three are small tables that the driver has just made
    return cuts.crossJoin(F.broadcast(groups)).crossJoin(F.broadcast(policies(spark, dims)))


def pairs_to_index(plan: DataFrame, limits: DataFrame) -> DataFrame:
    """Distinct (chunk, solape, encoder) of a plan whose chunks fit the encoder's window; limits: encoder, max_tokens."""
    rows = plan.select("chunk", "solape", F.explode("encoders").alias("encoder")).distinct().join(limits, "encoder")
    return rows.filter(F.col("chunk") + config.TOKEN_MARGIN <= F.col("max_tokens")).select("chunk", "solape", "encoder")


def window_problems(plan: DataFrame, limits: DataFrame) -> DataFrame:
    """The pairs that don't fit."""
    rows = plan.select("chunk", "solape", F.explode("encoders").alias("encoder")).distinct().join(limits, "encoder")
    return rows.filter(F.col("chunk") + config.TOKEN_MARGIN > F.col("max_tokens")).select("chunk", "encoder", "max_tokens").distinct()


def ceiling(chunk, strategy):
    """Tokens of the longest chunk a strategy can make."""
    return F.when(strategy == "jerarquica", F.greatest(chunk, F.lit(650))).otherwise(chunk)


@dataclass(frozen=True)
class Recipe:
    """A named configuration."""

    name: str
    encoders: tuple[str, ...] = ("a",)
    chunk: int = config.CHUNK_TOKENS
    solape: float = config.CHUNK_OVERLAP
    fusion: str = "rrf"
    agregacion: str = config.AGGREGATION
    umbral: float | None = None
    max_por_doc: int = config.PER_DOC
    estrategia: str = "fija"
    notes: str = field(default="", compare=False)

    def problems(self, limits: dict[str, int]) -> list[str]:
        out = [f"unknown encoder {e}" for e in self.encoders if e not in limits]
        need = max(self.chunk, 650) if self.estrategia == "jerarquica" else self.chunk
        out += [f"{e} holds {limits[e]} tokens" for e in self.encoders if e in limits and need + config.TOKEN_MARGIN > limits[e]]
        if self.fusion != "rrf" and len(self.encoders) < 2:
            out.append("a fusion needs two encoders")
        return out


#: The catalogue of recipes; encoders by their place (a: the main one, b and c: others, d: a smaller one).
RECIPES = {
    r.name: r
    for r in (
        Recipe("entrega"),
        Recipe("dos-encoders", ("a", "b"), agregacion="max"),
        Recipe("convexa", ("a", "b"), fusion="convexa"),
        Recipe("familias", ("a", "c")),
        Recipe("filtrado", ("a", "b"), umbral=0.9),
        Recipe("barato", ("d",)),
        Recipe("sin-recorte", chunk=345),
        Recipe("granular", chunk=256, solape=0.0, max_por_doc=5, agregacion="max"),
        Recipe("contexto", chunk=768, max_por_doc=5, agregacion="top3"),
        Recipe("jerarquico-v1", estrategia="jerarquica"),
    )
}


def select(names: str) -> list[str]:
    """Recipes of a comma list in the order of the catalogue; `todas` for all."""
    wanted = {n.strip() for n in names.split(",") if n.strip()}
    if wanted == {"todas"}:
        return list(RECIPES)
    if unknown := wanted - set(RECIPES):
        raise ValueError(f"unknown recipes: {', '.join(sorted(unknown))}")
    return [n for n in RECIPES if n in wanted]


def measurable(names: list[str], chunk: int, solape: float, available: set[str]) -> tuple[list[str], list[tuple[str, str]]]:
    """Recipes that an index of this chunking and these encoders can measure, and why the others can't."""
    good, bad = [], []
    for n in names:
        r = RECIPES[n]
        lacking = [e for e in r.encoders if e not in available]
        if (r.chunk, r.solape, r.estrategia) != (chunk, solape, "fija"):
            bad.append((n, "other chunking"))
        elif lacking:
            bad.append((n, f"no index of {', '.join(lacking)}"))
        else:
            good.append(n)
    return good, bad


def parse_list(text: str | None, kind: str = "texto") -> list | None:
    """A comma list of texto, entero, real, bool or umbral (a number or `no`)."""
    if text is None:
        return None
    cast = {
        "texto": str, "entero": int, "real": float, "bool": lambda x: x.lower() in ("1", "si", "sí", "true"),
        "umbral": lambda x: None if x.lower() in ("no", "none", "0") else float(x),
    }[kind]
    return [cast(x.strip()) for x in text.split(",") if x.strip()]


def run_many(rankings: DataFrame, chunks: DataFrame, queries: DataFrame, qrels: DataFrame, relevant: DataFrame, runs: list[dict]) -> DataFrame:
    """(idx, ndcg, f1, queries) of many policies over one stored ranking: searched once, reordered for each run.

    A run has encoders, depth, fusion, k0, share and aggregation. One job for all runs.
    """
    out = None
    for k, run in enumerate(runs):
        rows = fusion.depth(rankings.filter(F.col("encoder").isin(run.get("encoders", ["a", "b"]))), run.get("depth", config.CANDIDATES))
        frags, docs = fusion.reorder(rows, chunks, queries, run.get("fusion", "rrf"), run.get("aggregation", config.AGGREGATION), run.get("share"), run.get("k0", config.RRF_K0))
        scored = evaluation.evaluate(frags.withColumnRenamed("pos", "rank"), docs, qrels, relevant)
        one = evaluation.summary(scored).withColumn("idx", F.lit(k))
        out = one if out is None else out.unionByName(one)
    return out.select("idx", "ndcg", "f1", "queries")


def stage_plan(encoders: list[str], ocr: bool = True, graph: bool = True, since: str | None = None) -> list[str]:
    """Names of the build stages in order, from one of them on."""
    stages = ["extraer", *(["ocr"] if ocr else []), "fragmentar", *[f"indexar-{e}" for e in encoders], *(["grafo"] if graph else []), "empaquetar", "verificar"]
    if since is None:
        return stages
    if since not in stages:
        raise ValueError(f"unknown stage {since}")
    return stages[stages.index(since) :]


def best_of(results: DataFrame) -> DataFrame:
    """Best values of each experiment; results has experimento, ndcg, f1."""
    return results.groupBy("experimento").agg(F.max("ndcg").alias("ndcg"), F.max("f1").alias("f1"), F.count(F.lit(1)).alias("corridas"))


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two results has, with the side."""
    left = a.exceptAll(b).withColumn("lado", F.lit("a"))
    return left.unionByName(b.exceptAll(a).withColumn("lado", F.lit("b")))


def recipe_plan(spark: SparkSession, names: list[str]) -> DataFrame:
    """A row per recipe."""
    rows = [(k, r.name, list(r.encoders), r.chunk, r.solape, r.fusion, r.agregacion, r.umbral, r.max_por_doc, r.estrategia) for k, r in enumerate(RECIPES[n] for n in names)]
    return spark.createDataFrame(rows, "idx int, receta string, encoders array<string>, chunk int, solape double, fusion string, agregacion string, umbral double, max_por_doc int, estrategia string")


def to_build(pairs: DataFrame, built: DataFrame) -> DataFrame:
    """Chunkings and encoders that a plan needs and that aren't there yet."""
    return pairs.join(built, ["chunk", "solape", "encoder"], "left_anti")


def preflight(have: dict[str, bool]) -> list[str]:
    """What is missing among the named parts of an environment, in order."""
    return [f"missing: {name}" for name, there in have.items() if not there]


#: Backends for encoders, best first.
BACKENDS = ("cuda", "directml", "cpu")


def pick_backend(have: dict[str, bool]) -> tuple[str, str]:
    """The best backend that is there, and why; cpu always is."""
    for name in BACKENDS[:-1]:
        if have.get(name):
            return name, f"{name} is there"
    return "cpu", "no " + " and no ".join(BACKENDS[:-1])
