"""Near-duplicate detection by a chosen-path similarity join over minwise tokens.

Texts with equal shingle sets form a class, and one row stands for it. Every independent tree starts with all classes in
its root; a node branches each of its documents by minwise tokens at signature places that the node's path selects, so
two documents share a child with a chance of their similarity per branch. Nodes hold signatures, not texts. Small nodes
are compared exhaustively; the candidates of all nodes are then checked once on full sets. Large nodes of documents that
are little alike branch on. In those of like documents, which branching wouldn't part, a few leaders connect most, and a
second look compares exhaustively, in blocks of bounded size, what the checked links leave apart. Components come from
label propagation in tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .workspace import Workspace, only, with_row_key

#: Places of a signature.
PLACES = 64
TREES = 4
#: Children of a document in a node, at every level. At 0.8 a shared path dies out in one tree with a chance of 1/16.
BRANCHES = 2
#: A node of up to so many documents is small: one task compares their signatures.
SMALL = 2048
#: Large nodes whose documents have at least this mean estimate with their leaders are compared in blocks: a level of
#: branching would double the rows and leave most pairs together. So are nodes that are large after so many levels.
DENSE, DEEPEST = 0.4, 12
#: While all large nodes together have at most so many pairs for each document, they are all compared in blocks: that
#: costs less than another level. The result is the same.
PAIRS = 4000
#: Leaders of a large node, on average.
LEADERS = 8
#: Documents of dense nodes are also checked with the first one that shares one of so many keys of so many places.
STARS, STAR_PLACES = 6, 5
#: Estimated similarity from which a pair is checked exactly: one at 0.8 falls below it with a chance of 4e-6.
CHECK = 0.55
#: Documents and shingles on one side of a block, about.
BLOCK, BLOCK_SHINGLES = 1024, 500_000
#: Roles of documents in the blocks of the second look: those apart from the rest of their group, and all of it.
FAMILY, VISITOR = 1, 2

_SEEDS = K.stream(21, PLACES)
_ODD = K.stream(22, PLACES) | np.uint64(1)


def shingle_sets(part: K.Slice, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every text of a slice: text numbers, hashes (both sorted), and set sizes.

    A text of fewer words than the size has its whole sequence as its one shingle.
    """
    w = K.words(part, lower=True)
    hashes, at = K.grams(w, size)
    text = w.text[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < size))
    if len(short):
        whole = []
        for t in short:
            h = np.uint64(w.counts[t])
            for k in range(w.first[t], w.first[t] + w.counts[t]):
                with np.errstate(over="ignore"):
                    h = K.mix(np.array([h * np.uint64(31) + w.hash[k]], np.uint64))[0]
            whole.append(h)
        hashes, text = np.r_[hashes, np.array(whole, np.uint64)], np.r_[text, short]
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])] if len(text) else np.zeros(0, bool)
    hashes, text = hashes[new], text[new]
    return text, hashes, np.bincount(text, minlength=len(part))


def signatures(hashes: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Minwise values (64 bits) of sets that begin at heads, one row per set."""
    out = np.empty((PLACES, len(heads)), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(PLACES):
            out[k] = np.minimum.reduceat((hashes ^ _SEEDS[k]) * _ODD[k], heads)
    return out.T


def children(path: np.ndarray, values: np.ndarray, branches: int) -> np.ndarray:
    """Paths of the children of documents in nodes: the path selects the places, the tokens there name the child."""
    out = np.empty((len(path), branches), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(branches):
            place = (K.mix(path + np.uint64(b + 1)) % np.uint64(PLACES)).astype(np.int64)
            token = values[np.arange(len(path)), place]
            out[:, b] = K.mix(path * np.uint64(0x9E3779B97F4A7C15) + K.mix(token + place.astype(np.uint64)))
    return out


def _sketch(size: int):
    def run(batches):
        roots = K.stream(23, TREES)
        for batch in batches:
            for part in K.slices(batch.column(1)):
                text, hashes, sizes = shingle_sets(part, size)
                n = len(part)
                h1, h2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                full = np.flatnonzero(sizes)
                signature = [None] * n
                paths = [None] * n
                if len(full):
                    heads = (np.cumsum(sizes) - sizes)[full]
                    with np.errstate(over="ignore"):
                        h1[full], h2[full] = np.add.reduceat(hashes, heads), np.add.reduceat(K.mix(hashes + np.uint64(5)), heads)
                    values = signatures(hashes, heads)
                    first = np.concatenate([children(np.full(len(full), r), values >> np.uint64(32), BRANCHES) for r in roots], axis=1)
                    # the first level keeps all bits of its tokens apart
                    short = (values >> np.uint64(32)).astype(np.uint32)
                    for k, t in enumerate(full):
                        signature[t] = short[k].tobytes()
                        paths[t] = K.signed(np.unique(first[k]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, n), batch.column(2).slice(part.first, n), pa.array(sizes.astype(np.int64)), pa.array(K.signed(h1)), pa.array(K.signed(h2)),
                        pa.array(signature, pa.binary()), pa.array(paths, pa.list_(pa.int64())),
                    ],
                    ["id", "named", "n", "h1", "h2", "signature", "paths"],
                )

    return run


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), PLACES)


def _hits(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every one on the right.

    Shingles that the same sets hold are one weighted column, so near copies cost little whatever their length.
    """
    n, m = len(left), len(right)
    out = np.zeros((n, m), np.int64)
    if n == 1 and m == 1:
        out[0, 0] = _hits(left[0], right[0])
        return out
    both = [*left, *right]
    owner = np.repeat(np.arange(n + m), [len(x) for x in both])
    hashes = np.concatenate([np.zeros(0, np.uint64), *both])
    if not len(hashes):
        return out
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order]
    head = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    size = np.diff(np.r_[head, len(hashes)])
    on_left = np.add.reduceat((owner < n).astype(np.int64), head)
    used = np.flatnonzero((on_left > 0) & (on_left < size))
    if not len(used):
        return out
    with np.errstate(over="ignore"):
        holders = np.add.reduceat(K.stream(24, n + m)[owner], head)[used]
    _, first, weight = np.unique(holders, return_index=True, return_counts=True)
    column, kind = used[first], np.float32 if len(hashes) < 1 << 24 else np.float64
    for lo in range(0, len(column), 2048):
        part, w = column[lo : lo + 2048], weight[lo : lo + 2048]
        lengths = size[part]
        ends = np.cumsum(lengths)
        row = owner[np.arange(ends[-1]) + np.repeat(head[part] - (ends - lengths), lengths)]
        at = np.repeat(np.arange(len(part)), lengths)
        a, b, mine = np.zeros((n, len(part)), kind), np.zeros((m, len(part)), kind), row < n
        a[row[mine], at[mine]] = w[at[mine]]
        b[row[~mine] - n, at[~mine]] = 1
        out += np.rint(a @ b.T).astype(np.int64)
    return out


def _alike(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, percent: int, later: bool = False):
    """Blocks of rows of a against all of b (or those from the block on): numbers of candidates, and their estimates."""
    for lo in range(0, len(a), 32):
        first = lo if later else 0
        est = (a[lo : lo + 32, None, :] == b[None, first:, :]).mean(axis=2, dtype=np.float32)
        s, t = sizes_a[lo : lo + 32, None], sizes_b[first:]
        ok = (est >= CHECK) & (100 * np.minimum(s, t) >= percent * np.maximum(s, t))
        i, j = np.nonzero(ok)
        yield i + lo, j + first, est[i, j]


def spanning(n: int, a: np.ndarray, b: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """Numbers of edges of a forest that connects what the edges connect, of greatest worth first (Boruvka's rounds)."""
    order = np.argsort(-worth, kind="stable")
    label, chosen = np.arange(n), []
    while len(order):
        la, lb = label[a[order]], label[b[order]]
        order = order[la != lb]
        if not len(order):
            break
        la, lb = label[a[order]], label[b[order]]
        _, first = np.unique(np.stack([la, lb], axis=1).reshape(-1), return_index=True)
        for e in np.unique(first // 2).tolist():
            x, y = int(label[a[order[e]]]), int(label[b[order[e]]])
            if x != y:
                chosen.append(int(order[e]))
                label[label == max(x, y)] = min(x, y)
    return np.array(sorted(chosen), np.int64)


def _runs(batches, keys: int, rows: int = 4000):
    """Tables of the rows of one key after another; the keys are the first columns, and equal ones lie together."""
    held: list[pa.RecordBatch] = []
    last = None
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            batch = whole.slice(at, rows)
            key = np.stack([batch.column(k).to_numpy() for k in range(keys)], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            if held and (key[0] != last).any():
                yield pa.Table.from_batches(held)
                held = []
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
                if lo:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
            last = key[-1]
    if held:
        yield pa.Table.from_batches(held)


def _compare_small(percent: int):
    """Members of small nodes (node, id, n, signature), sorted by node: pairs to check, and whether that is all of them.

    All candidates of a node if they are few, else a forest of them: the second look sees what that leaves apart.
    """

    def run(batches):
        out: list[list] = [[], [], [], []]

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()))], ["node", "a", "b", "more"])
            for c in out:
                c.clear()
            return made

        for table in _runs(batches, 1):
            node, ids, sizes = table.column(0)[0].as_py(), table.column(1).to_numpy(), table.column(2).to_numpy()
            sig = _matrix(table.column(3))
            found = [(i[i < j], j[i < j], e[i < j]) for i, j, e in _alike(sig, sig, sizes, sizes, percent, later=True)]
            i, j, est = (np.concatenate(x) for x in zip(*found))
            more = len(i) > 2 * len(ids)
            if more:
                use = spanning(len(ids), i, j, est)
                i, j = i[use], j[use]
            for x, y in zip(ids[i].tolist(), ids[j].tolist()):
                for c, v in zip(out, (node, min(x, y), max(x, y), more)):
                    c.append(v)
            if len(out[0]) > 20_000:
                yield batch()
        yield batch()

    return run


def _compare_leaders(batches):
    """Members of large nodes (node, id, signature, leaders): mean estimate with the leaders, and the two nearest others.

    The nearest are checked: they connect most of what is alike, and the second look does the rest.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = _matrix(batch.column(2))
        node, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        like, to = np.zeros(len(node)), [[] for _ in node]
        for x in np.unique(node):
            rows = np.flatnonzero(node == x)
            leaders = batch.column(3)[int(rows[0])].as_py()
            ids = np.array([k["id"] for k in leaders], np.int64)
            other = np.stack([np.frombuffer(k["signature"], np.uint32) for k in leaders])
            est = np.stack([(sig[rows] == g).mean(axis=1) for g in other], axis=1)
            like[rows] = est.mean(axis=1)
            est = np.where(own[rows][:, None] == ids, -1, est)
            for k in np.argsort(-est, axis=1, kind="stable")[:, :2].T:
                for i in np.flatnonzero(est[np.arange(len(rows)), k] >= CHECK):
                    to[rows[i]].append(int(ids[k[i]]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(like), pa.array(to, pa.list_(pa.int64()))], ["node", "id", "like", "near"])


def _keys(batches):
    """Rows (id, signature) of dense nodes: STARS keys of STAR_PLACES places each. Who shares one is very likely linked."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = _matrix(batch.column(1)).astype(np.uint64)
        with np.errstate(over="ignore"):
            keys = [K.mix(sum(K.mix(sig[:, r * STAR_PLACES + k] + np.uint64(k)) * _ODD[k] for k in range(STAR_PLACES)) + np.uint64(r)) for r in range(STARS)]
        yield pa.RecordBatch.from_arrays([pa.array(K.signed(np.concatenate(keys))), pa.concat_arrays([batch.column(0)] * STARS)], ["key", "id"])


def _branch(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        path = batch.column(0).to_numpy().view(np.uint64)
        made = children(path, _matrix(batch.column(3)).astype(np.uint64), BRANCHES)
        ids = np.repeat(np.arange(len(path)), BRANCHES)
        yield pa.RecordBatch.from_arrays([pa.array(K.signed(made.reshape(-1))), *[batch.column(k).take(pa.array(ids)) for k in (1, 2)]], ["node", "id", "n"])


def _sets(texts: pa.Array | pa.ChunkedArray, size: int) -> list[np.ndarray]:
    out = []
    for part in K.slices(texts):
        _, hashes, sizes = shingle_sets(part, size)
        out += np.split(hashes, np.cumsum(sizes)[:-1])
    return out


def _confirm(size: int, percent: int):
    """Exact comparison of pairs of texts (a, b, ta, tb)."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                cut = batch.slice(lo, 64)
                # texts that stand in several pairs are cut into shingles once
                left, right = cut.column(2).dictionary_encode(), cut.column(3).dictionary_encode()
                a, b = _sets(left.dictionary, size), _sets(right.dictionary, size)
                ok = []
                for i, j in zip(left.indices.to_pylist(), right.indices.to_pylist()):
                    both = _hits(a[i], b[j])
                    ok.append(both > 0 and 100 * both >= percent * (len(a[i]) + len(b[j]) - both))
                yield pa.RecordBatch.from_arrays([cut.column(0), cut.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _meet_signatures(percent: int):
    """Rows (gid, u, v, role, id, label, n, signature): those with a candidate of another label in the other role."""

    def run(batches):
        for table in _runs(batches, 3):
            role, label, sizes = (table.column(k).to_numpy() for k in (3, 5, 6))
            f, v = np.flatnonzero(role == FAMILY), np.flatnonzero(role == VISITOR)
            if not len(f) or not len(v):
                continue
            sig, use = _matrix(table.column(7)), np.zeros(len(role), bool)
            for i, j, _ in _alike(sig[f], sig[v], sizes[f], sizes[v], percent):
                apart = label[f[i]] != label[v[j]]
                use[f[i[apart]]] = use[v[j[apart]]] = True
            out = table.filter(pa.array(use)).select([0, 3, 4]).combine_chunks()
            yield from out.to_batches()

    return run


def _meet_sets(size: int, percent: int):
    """Rows (gid, u, v, role, id, label, text): one link for each two labels that are linked across the roles."""

    def run(batches):
        for table in _runs(batches, 3):
            role, ids, label = (table.column(k).to_numpy() for k in (3, 4, 5))
            f, v = np.flatnonzero(role == FAMILY), np.flatnonzero(role == VISITOR)
            if not len(f) or not len(v):
                continue
            sets = _sets(table.column(6), size)
            n = np.array([len(x) for x in sets])
            both = intersections([sets[k] for k in f], [sets[k] for k in v])
            ok = (both > 0) & (100 * both >= percent * (n[f][:, None] + n[v] - both)) & (label[f][:, None] != label[v])
            i, j = np.nonzero(ok)
            _, first = np.unique(np.sort(np.stack([label[f[i]], label[v[j]]], axis=1), axis=1), axis=0, return_index=True)
            a, b = ids[f[i[first]]], ids[v[j[first]]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return run


def components(edges: DataFrame, ws: Workspace) -> DataFrame:
    """(id, label): the smallest id reachable over the edges (a, b), for every id that has one.

    Each round takes the smallest label among neighbours and then that label's own label; tables only, one job a round,
    and as many rounds as the logarithm of a component's width.
    """
    both = ws.save(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "edges")
    labels = ws.save(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("id"), "label"), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("_near"))
        met = labels.join(near, "id").select("id", F.col("label").alias("_was"), F.least("label", "_near").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("_far"))
        nxt = ws.save(met.join(jump, "label", "left").select("id", "_was", F.least("label", F.coalesce("_far", "label")).alias("label")), "labels")
        changed = nxt.filter(F.col("label") < F.col("_was")).limit(1).count()
        labels = nxt.select("id", "label")
        if not changed:
            return labels


def with_more(labels: DataFrame, more: DataFrame, ws: Workspace) -> DataFrame:
    """The labels after more edges, by the components of the labels that these connect."""
    if not more.limit(1).count():
        return labels
    for c in ("a", "b"):
        more = more.join(labels.select(F.col("id").alias(c), F.col("label").alias("_l")), c, "left").withColumn(c, F.coalesce("_l", c)).drop("_l")
    merged = components(more.select("a", "b"), ws).select(F.col("id").alias("label"), F.col("label").alias("_to"))
    known = labels.join(merged, "label", "left").select("id", F.coalesce("_to", "label").alias("label"))
    # ids that the first links left alone stand for themselves among the merged ones
    alone = merged.select(F.col("label").alias("id"), F.col("_to").alias("label")).join(labels.select("id"), "id", "left_anti")
    return ws.save(known.unionByName(alone), "labels")


def small_node_pairs(members: DataFrame, small: DataFrame, reps: DataFrame, percent: int, ws: Workspace) -> DataFrame:
    """(node, a, b, more) of the small nodes; nodes with the same members are compared once."""
    once = small.groupBy("size", "who1", "who2").agg(F.min("node").alias("node")).select("node")
    rows = members.join(once, "node").join(reps.select("id", "signature"), "id").select("node", "id", "n", "signature")
    tasks = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "node").sortWithinPartitions("node")
    return ws.save(rows.mapInArrow(_compare_small(percent), "node long, a long, b long, more boolean"), "pairs")


@dataclass
class Found:
    """What the trees give: pairs (a, b) to check, and groups (gid, id, n) of which all pairs may count."""

    pairs: DataFrame
    groups: DataFrame


def walk_trees(reps: DataFrame, members: DataFrame, percent: int, ws: Workspace) -> Found:
    """Branch large nodes of documents that are little alike, until none is left; large nodes of others are groups."""
    pairs, groups, depth, documents = [], [], 1, reps.count()
    while True:
        sized = members.groupBy("node").agg(
            F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("id")).alias("who1"), F.sum(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 40))).alias("who2"),
        )
        sized = ws.save(sized.filter("size > 1"), "sized")
        found = small_node_pairs(members, sized.filter(F.col("size") <= SMALL), reps, percent, ws)
        pairs.append(found.select("a", "b"))
        groups.append(members.join(found.filter("more").select("node").distinct(), "node").select(F.col("node").alias("gid"), "id", "n"))
        big = sized.filter(F.col("size") > SMALL).groupBy("size", "who1", "who2").agg(F.min("node").alias("node")).select("node", "size")
        work = sized.filter(F.col("size") > SMALL).agg(F.sum(F.col("size").cast("double") * F.col("size"))).first()[0]
        if not work:
            break
        last = depth > DEEPEST or work <= PAIRS * documents
        signed = ws.save(members.join(big, "node").join(reps.select("id", "signature"), "id").select("node", "id", "n", "signature", "size"), "signed")
        # LEADERS of a node on average: the list stays short, whatever the node's size; like nodes have the same ones
        part = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1 << 40)) / float(1 << 40)
        chosen = signed.filter(part * F.col("size") < LEADERS).groupBy("node").agg(F.collect_list(F.struct("id", "signature")).alias("leaders"))
        held = signed.join(chosen, "node").select("node", "id", "signature", "leaders").mapInArrow(_compare_leaders, "node long, id long, like double, near array<long>")
        held = ws.save(held, "large")
        dense = held.groupBy("node").agg(F.avg("like").alias("like")).filter(F.col("like") >= DENSE).select("node")
        other = (held if last else held.join(dense, "node")).select("id", F.explode("near").alias("other"))
        pairs.append(other.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")))
        alike = signed if last else signed.join(dense, "node")
        groups.append(alike.select(F.col("node").alias("gid"), "id", "n"))
        keys = ws.save(alike.select("id", "signature").dropDuplicates(["id"]).mapInArrow(_keys, "key long, id long"), "keys")
        first = keys.groupBy("key").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("key", "a")
        pairs.append(keys.join(first, "key").filter("a <> id").select("a", F.col("id").alias("b")))
        if last:
            break
        # the others branch, also those without a leader, as chance has it
        rest = signed.join(dense, "node", "left_anti").select("node", "id", "n", "signature")
        members = ws.save(rest.mapInArrow(_branch, "node long, id long, n long"), "members")
        depth += 1
    return Found(ws.save(reduce(DataFrame.unionByName, pairs).distinct(), "candidates"), ws.save(reduce(DataFrame.unionByName, groups), "groups"))


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int, ws: Workspace) -> DataFrame:
    """The pairs whose texts' full sets reach the similarity."""
    rows = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")).hint("merge"), "a")
    rows = rows.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")).hint("merge"), "b")
    return ws.save(rows.select("a", "b", "ta", "tb").mapInArrow(_confirm(size, percent), "a long, b long"), "links")


def _blocks(rows: DataFrame, kind: list[str]) -> DataFrame:
    """Rows (gid, role, id, label, n) dealt into blocks (gid, u, v): each family block meets each visitor block once."""
    per = rows.groupBy("gid", "role").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("b"))
    sides = per.groupBy("gid").agg(F.max(F.when(F.col("role") == FAMILY, F.col("b"))).alias("bf"), F.max(F.when(F.col("role") == VISITOR, F.col("b"))).alias("bv"))
    rows = rows.join(sides.filter("bf IS NOT NULL AND bv IS NOT NULL"), "gid")
    mine = F.col("role") == FAMILY
    block = F.pmod(F.xxhash64("id", F.lit(3)), F.when(mine, F.col("bf")).otherwise(F.col("bv")))
    rows = rows.select("*", block.alias("_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.when(mine, F.col("bv")).otherwise(F.col("bf")) - 1)).alias("_other"))
    u, v = F.when(mine, F.col("_block")).otherwise(F.col("_other")), F.when(mine, F.col("_other")).otherwise(F.col("_block"))
    return rows.select("gid", u.alias("u"), v.alias("v"), *kind)


def second_look(found: Found, labels: DataFrame, reps: DataFrame, texts: DataFrame, size: int, percent: int, ws: Workspace) -> DataFrame | None:
    """Links (a, b) between documents of a group that the labels leave apart; None if there is no such group.

    Documents that don't have their group's commonest label meet all of the group, blocks against blocks: signatures
    first, then full sets of those with a candidate. No pair is a row.
    """
    own = ws.save(found.groups.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id")), "labelled")
    if not own.limit(1).count():
        return None
    counts = own.groupBy("gid", "label").agg(F.count(F.lit(1)).alias("k"))
    main = counts.groupBy("gid").agg(F.max_by("label", F.struct("k", "label")).alias("main"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    own = own.join(main.select("gid", "main"), "gid")
    roles = F.explode(F.when(F.col("label") == F.col("main"), F.array(F.lit(VISITOR))).otherwise(F.array(F.lit(VISITOR), F.lit(FAMILY))))
    rows = ws.save(own.select("gid", roles.alias("role"), "id", "label", "n"), "apart")
    if not rows.limit(1).count():
        return None
    tasks = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def meet(table: DataFrame) -> DataFrame:
        return table.repartition(tasks, "gid", "u", "v").sortWithinPartitions("gid", "u", "v")

    signed = _blocks(rows, ["role", "id", "label", "n"]).join(reps.select("id", "signature").hint("merge"), "id").select("gid", "u", "v", "role", "id", "label", "n", "signature")
    hit = ws.save(meet(signed).mapInArrow(_meet_signatures(percent), "gid long, role int, id long").distinct(), "hit")
    full = _blocks(rows.join(hit, ["gid", "role", "id"], "left_semi"), ["role", "id", "label"])
    full = full.join(texts.hint("merge"), "id").select("gid", "u", "v", "role", "id", "label", "text")
    return ws.save(meet(full).mapInArrow(_meet_sets(size, percent), "a long, b long"), "more")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80,
) -> DataFrame:
    """A row per input row: id, n_shingles, component_id (smallest id reachable) and kept (id = component_id).

    Rows are linked if 100 * intersection >= percent * union of their shingle sets. Null, empty and word-less texts are
    linked with nothing. Rows that repeat an id are one document: their links add up. A null id is linked with nothing,
    has a null component_id and is kept. Other columns are left out. An empty table gives no rows.
    """
    ws = Workspace(docs.sparkSession, "near")
    keyed = with_row_key(only(docs, id_col, text_col), id_col, ws)
    repeated = hasattr(keyed, "_workspace_path")
    docs = keyed.select(F.col("_row").alias("id"), F.col(text_col).alias("text"), F.col(id_col).isNotNull().alias("named"))
    kind = "id long, named boolean, n long, h1 long, h2 long, signature binary, paths array<long>"
    sketch = ws.save(docs.mapInArrow(_sketch(size), kind), "sketch")
    linked = sketch.filter("named AND n > 0")
    classes = ws.save(linked.groupBy("h1", "h2", "n").agg(F.min("id").alias("rep")), "classes")
    mine = ws.save(linked.select("id", "h1", "h2", "n").join(classes.hint("merge"), ["h1", "h2", "n"]).select("id", "rep"), "mine")
    reps = linked.join(classes.select(F.col("rep").alias("id")).hint("merge"), "id", "left_semi")
    reps = ws.save(reps.select("id", "n", "signature", "paths"), "reps")
    members = ws.save(reps.select(F.explode("paths").alias("node"), "id", "n"), "members")
    found = walk_trees(reps, members, percent, ws)
    ids = [found.pairs.select(F.col(c).alias("id")) for c in ("a", "b")] + [found.groups.select("id")]
    wanted = ws.save(reduce(DataFrame.unionByName, ids).distinct(), "wanted")
    texts = ws.save(docs.select("id", "text").join(wanted.hint("merge"), "id", "left_semi"), "texts")
    links = confirmed(found.pairs, texts, size, percent, ws)
    labels = components(links, ws)
    more = second_look(found, labels, reps, texts, size, percent, ws)
    if not repeated:
        labels = (labels if more is None else with_more(labels, more, ws)).select(F.col("id").alias("rep"), "label")
        full = mine.join(labels, "rep", "left").select("id", F.coalesce("label", "rep").alias("label"))
        out = sketch.select("id", "n").join(full, "id", "left")
        component = F.coalesce("label", "id")
        return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("id") == component).alias("kept"))
    # rows of one class and rows of one id are linked by their first one
    copies = mine.filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    names = keyed.select(F.col("_row").alias("id"), F.col(id_col).alias("_name")).filter("_name IS NOT NULL")
    first = names.groupBy("_name").agg(F.min("id").alias("a"))
    same = names.join(first, "_name").filter("a <> id").select("a", F.col("id").alias("b"))
    every = [links, copies, same] + ([] if more is None else [more])
    labels = components(reduce(DataFrame.unionByName, every), ws)
    named = ws.save(names.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id")), "named")
    least = named.groupBy("label").agg(F.min("_name").alias("component_id"))
    out = keyed.select(F.col("_row").alias("id"), F.col(id_col)).join(sketch.select("id", "n"), "id")
    out = out.join(named.select("id", "label").join(least, "label").select("id", "component_id"), "id", "left")
    kept = F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))
    return out.select(id_col, F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query: all documents, four-word shingles, similarity of 0.8 or more."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=4)


#: All pairs of documents that share a shingle, and what is reachable over those that are linked.
OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words
), rows AS (SELECT doc_id, len(s) AS n, md5(unnest(s)) AS h FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM rows a JOIN rows b ON a.h = b.h AND a.doc_id < b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT r.x, e.b FROM reach r JOIN edges e ON e.a = r.y),
least AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""


def near_duplicates_by_hand(rows: list[tuple[int | None, str | None]], size: int = 4, percent: int = 80) -> dict:
    """The same for a few rows with distinct ids, over all pairs: id -> (n_shingles, component_id, kept)."""
    import re

    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                r, s = sorted((root(i), root(j)))
                label[s] = r
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}
