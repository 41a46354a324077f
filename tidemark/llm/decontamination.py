"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Benchmark texts are cut into overlapping probes of one length. A document region within k edits of a probe of m
characters shares at least m + 1 - q - k * q of its q-grams, all on diagonals at most k apart. So shared q-grams are
counted in overlapping bands of diagonals, bands that reach the bound are kept, and a banded alignment of the probe with
the region settles the distance. q-grams that the same probes hold at the same distances are counted as one, so a stem
that many items share isn't expanded gram by gram. The probes, not the documents, are what a task holds; a benchmark
too large for one task is taken in blocks, every block against all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .workspace import Workspace, only

Q = 9
#: Edits per 100 characters of a probe.
EDITS = 9
#: Share of a probe's length that the bound on shared q-grams must keep: chance reaches less.
LEAST_SHARE = 0.18
#: Characters of a probe, and from one probe's beginning to the next: any PROBE + STRIDE - 1 characters hold a whole one.
PROBE, STRIDE = 72, 24
#: Shorter items have no useful q-gram bound: they are met exactly, as whole words; those under Q, as whole lines.
SHORTEST = 40
#: Characters of benchmark text that one block holds.
BLOCK_CHARS = 2_000_000
#: Characters of documents that are searched at once (a longer text is taken whole), and shared q-grams expanded at once.
CHUNK_CHARS, EXPANDED = 500_000, 1_000_000

_OTHER = re.compile(r"[\W_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> str:
    """Lower case, every run of anything but letters and digits one space, none at the ends."""
    return _OTHER.sub(" ", (text or "").lower()).strip()


@lru_cache(1)
def _alnum() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def normal_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of normal() of all texts, each ended by a 0, and where each begins (one more than texts)."""
    low = [(t or "").lower() for t in texts]
    codes = np.frombuffer("\0".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, low), np.int64, len(low)) + 1)
    word = _alnum()[codes]
    keep = word.copy()
    keep[:-1] |= word[1:]  # the last of a run of others before a word
    keep[ends - 1] = True
    at = np.flatnonzero(keep)
    begin = np.searchsorted(at, ends - np.diff(np.r_[0, ends]))
    first = at[begin]
    keep[first[~word[first] & (first != ends - 1)]] = False
    out = np.where(word, codes, np.uint32(32))
    out[ends - 1] = 0
    total = np.cumsum(keep)
    return out[keep], np.r_[0, total[ends - 1]]


def edit_budget(m: int, edits: int = EDITS, q: int = Q) -> int:
    """Edits allowed for a probe of m characters; few enough that the q-gram bound stays a good part of its length."""
    return max(0, min(m * edits // 100, (m + 1 - q - int(LEAST_SHARE * m)) // q))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _qgrams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all runs of q codes, put together from runs of 1, 2, 4, ... codes."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    run, size, out, done = codes.astype(np.uint64), 1, None, 0
    with np.errstate(over="ignore"):
        while True:
            power = np.uint64(pow(int(_STEP), size, 1 << 64))
            if q & size:
                out = run if out is None else out[: len(codes) - done - size + 1] * power + run[done:]
                done += size
            if done == q:
                return out[:n] * _STEP
            run = run[:-size] * power + run[size:]
            size *= 2


def probe_spans(length: int) -> list[tuple[int, int]]:
    """Where the probes of an item of that length begin and end; the last one ends with the item."""
    if length <= PROBE:
        return [(0, length)]
    starts = [*range(0, length - PROBE, STRIDE), length - PROBE]
    return [(s, s + PROBE) for s in starts]


class Probes:
    """Probes of a block of benchmark items with an index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, edits: int = EDITS):
        self.q, self.edits = q, edits
        held: dict[str, set[int]] = {}
        self.short: dict[str, set[int]] = {}
        self.tiny: dict[str, set[int]] = {}
        for item, text in items:
            t = normal(text)
            if len(t) >= SHORTEST:
                for a, b in probe_spans(len(t)):
                    held.setdefault(t[a:b], set()).add(item)
            elif t:
                (self.short if len(t) >= q else self.tiny).setdefault(t, set()).add(item)
        self.texts = sorted(held)
        self.items = np.array([i for t in self.texts for i in sorted(held[t])], np.int64)
        self.holds = np.array([len(held[t]) for t in self.texts], np.int64)
        self.item_at = np.cumsum(self.holds) - self.holds
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        self.budgets = np.array([edit_budget(m, edits, q) for m in self.lengths], np.int64)
        self.bounds = self.lengths + 1 - q - self.budgets * q
        self.codes = np.zeros((len(self.texts), max(self.lengths, default=0)), np.uint32)
        for k, t in enumerate(self.texts):
            self.codes[k, : len(t)] = _codes(t)
        self._index()
        self.first = {int(_qgrams(_codes(t)[:q], q)[0]): [] for t in self.short}
        for t in sorted(self.short):
            self.first[int(_qgrams(_codes(t)[:q], q)[0])].append((_codes(t), sorted(self.short[t])))
        known = np.unique(np.r_[self.gram, np.array(list(self.first), np.uint64)])
        bits = min(24, max(16, int(len(known) * 16).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.filter = np.zeros(1 << bits, bool)
        self.filter[(known >> self.shift).astype(np.int64)] = True

    def _index(self) -> None:
        grams = [_qgrams(self.codes[k, :m], self.q) for k, m in enumerate(self.lengths.tolist())]
        gram = np.concatenate([np.zeros(0, np.uint64), *grams])
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in grams]]).astype(np.int64)
        order = np.argsort(gram, kind="stable")
        gram, owner, place = gram[order], owner[order], place[order]
        self.gram, at = np.unique(gram, return_index=True)
        count = np.diff(np.r_[at, len(gram)])
        # grams of the same probes at the same distances are one class
        self.place = place[at]
        place = place - np.repeat(self.place, count)
        if len(at):
            with np.errstate(over="ignore"):
                tag = np.add.reduceat(K.mix(owner.astype(np.uint64) * _STEP + place.astype(np.uint64)), at)
        else:
            tag = np.zeros(0, np.uint64)
        _, one, self.kind = np.unique(tag, return_index=True, return_inverse=True)
        spot = np.concatenate([np.zeros(0, np.int64), *[np.arange(at[k], at[k] + count[k]) for k in one.tolist()]]).astype(np.int64)
        self.owner, self.rel = owner[spot], place[spot]
        self.size = count[one]
        self.at = np.cumsum(self.size) - self.size

    def _hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose q-gram may be known, and the q-grams."""
        grams = _qgrams(codes, self.q)
        at = np.flatnonzero(self.filter[(grams >> self.shift).astype(np.int64)])
        return at, grams[at]

    def regions(self, codes: np.ndarray, hits: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probes and diagonals of all bands that reach their bound, neighbours merged."""
        none = np.zeros(0, np.int64)
        if not len(self.gram) or not len(hits):
            return none, none
        g = np.minimum(np.searchsorted(self.gram, grams), len(self.gram) - 1)
        ok = self.gram[g] == grams
        hits, g = hits[ok], g[ok]
        # a region has at least `least` hits within the length of a probe: the others need no expansion
        least, reach = int(self.bounds.min()), int((self.lengths + self.budgets).max())
        if len(hits) < least:
            return none, none
        near = hits[least - 1 :] - hits[: len(hits) - least + 1] <= reach
        use = K.cover(np.flatnonzero(near), least, len(hits))
        hits, g = hits[use], g[use]
        if not len(hits):
            return none, none
        base = hits - self.place[g]
        key, weight = np.unique((base + reach << 32) | self.kind[g], return_counts=True)
        base, kind = (key >> 32) - reach, key & 0xFFFFFFFF
        upto = np.r_[0, np.cumsum(self.size[kind])]
        out, at = [], 0
        while at < len(base):
            # so many that their expansion is bounded, and all that can lie in one region with them
            to = max(at + 1, int(np.searchsorted(upto, upto[at] + EXPANDED)) - 1)
            last = int(np.searchsorted(base, base[min(to, len(base)) - 1] + 2 * reach, "right"))
            out.append(self._bands(base[at:last], kind[at:last], weight[at:last]))
            at = to
        probe, diagonal = (np.concatenate(x) for x in zip(*out))
        # of diagonals less than k+1 apart one is enough for align()
        _, one = np.unique((probe << 32) | (diagonal // (self.budgets[probe] + 1) + 1024), return_index=True)
        return probe[one], diagonal[one]

    def _bands(self, base: np.ndarray, kind: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = self.size[kind]
        ends = np.cumsum(count)
        spot = np.arange(int(ends[-1])) + np.repeat(self.at[kind] - (ends - count), count)
        probe, diagonal, weight = self.owner[spot], np.repeat(base, count) - self.rel[spot], np.repeat(weight, count)
        half = self.budgets[probe] + 1
        found = []
        for shift in (0, 1):  # bands of width 2(k+1), each overlapping half of its neighbours
            key = (probe << 32) | ((diagonal + shift * half) // (2 * half) + 1024)
            order = np.argsort(key, kind="stable")
            key = key[order]
            heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            good = heads[np.add.reduceat(weight[order], heads) >= self.bounds[key[heads] >> 32]]
            found.append((probe[order[good]], diagonal[order[good]]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def align(self, codes: np.ndarray, begin: np.ndarray, probe: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, ...]:
        """(probe, edits, start, end) of all candidates within their budgets.

        Fewest edits of the probe against any part of a text near the diagonal. A candidate across two texts (begin
        tells where texts begin) is tried in both. Equal probes against equal regions are aligned once.
        """
        pad = 3 * (self.budgets[probe] + 1)
        low, high = diagonal - pad, diagonal + self.lengths[probe] + pad
        a, b = (np.clip(np.searchsorted(begin, x, "right") - 1, 0, len(begin) - 2) for x in (low, high - 1))
        probe, text = np.repeat(probe, b - a + 1), np.arange((b - a + 1).sum()) + np.repeat(a - (np.cumsum(b - a + 1) - (b - a + 1)), b - a + 1)
        low, high = np.maximum(np.repeat(low, b - a + 1), begin[text]), np.minimum(np.repeat(high, b - a + 1), begin[text + 1] - 1)
        out = [np.zeros((4, 0), np.int64)]
        for m in np.unique(self.lengths[probe]).tolist():
            k = edit_budget(m, self.edits, self.q)
            width = m + 6 * (k + 1)
            use = np.flatnonzero((self.lengths[probe] == m) & (high - low >= m - k))
            power = K.stream(41, width + 1) | np.uint64(1)
            for at in range(0, len(use), 4096):
                rows = use[at : at + 4096]
                spot = low[rows][:, None] + np.arange(width)
                part = np.where(spot < high[rows][:, None], codes[np.minimum(spot, len(codes) - 1)], np.uint32(0xFFFFFFFF))
                with np.errstate(over="ignore"):
                    seen = (K.mix(part.astype(np.uint64)) * power[:-1]).sum(axis=1) + K.mix(probe[rows].astype(np.uint64)) * power[-1]
                _, one, same = np.unique(seen, return_index=True, return_inverse=True)
                edit, start, end = (x[same] for x in _semi_global(self.codes[probe[rows[one]], :m], part[one], k))
                ok = edit <= k
                rows = rows[ok]
                out.append(np.stack([probe[rows], edit[ok], low[rows] + start[ok], low[rows] + end[ok]]))
        return tuple(np.concatenate(out, axis=1))

    def search(self, texts: list[str | None]) -> np.ndarray:
        """Columns (text, item, edits, start, stop) of every probe or short item found; places are in the normalised text."""
        codes, begin = normal_codes(texts)
        hits, grams = self._hits(codes)
        probe, diagonal = self.regions(codes, hits, grams)
        rows = []
        if len(probe):
            probe, edits, start, end = self.align(codes, begin, probe, diagonal)
            t = np.searchsorted(begin, start, "right") - 1
            found = np.stack([t, probe, edits, start - begin[t], end - begin[t]])
            n = self.holds[probe]
            found = np.repeat(found, n, axis=1)
            found[1] = self.items[np.arange(n.sum()) + np.repeat(self.item_at[probe] - (np.cumsum(n) - n), n)]
            rows.append(found)
        more = []
        if self.first:
            for at, g in zip(hits.tolist(), grams.tolist()):
                for want, items in self.first.get(g, ()):
                    end = at + len(want)
                    whole = (at == 0 or codes[at - 1] in (0, 32)) and end < len(codes) and codes[end] in (0, 32)
                    if whole and (codes[at:end] == want).all():
                        t = int(np.searchsorted(begin, at, "right")) - 1
                        more += [(t, item, 0, at - int(begin[t]), end - int(begin[t])) for item in items]
        if self.tiny:
            for t, text in enumerate(texts):
                at = 0
                for line in (text or "").split("\n"):
                    key = normal(line)
                    if key in self.tiny:
                        before = normal((text or "")[:at])
                        start = len(before) + bool(before)
                        more += [(t, item, 0, start, start + len(key)) for item in sorted(self.tiny[key])]
                    at += len(line) + 1
        rows.append(np.array(more, np.int64).reshape(-1, 5).T)
        return np.concatenate(rows, axis=1)


def _semi_global(want: np.ndarray, part: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row by row the fewest edits that turn want into a stretch of part, and where that begins and ends."""
    n, width = part.shape
    span = np.arange(width + 1, dtype=np.int16)
    edits, starts, ends = (np.full(n, v, np.int64) for v in (most + 1, 0, 0))
    live = np.arange(n)
    cost = np.zeros((n, width + 1), np.int16)
    start = np.tile(span, (n, 1))
    for i in range(want.shape[1]):
        on = cost[:, :-1] + (part != want[:, i : i + 1])
        take = cost + np.int16(1)
        better = on <= take[:, 1:]
        np.copyto(take[:, 1:], on, where=better, casting="same_kind")
        first = start.copy()
        np.copyto(first[:, 1:], start[:, :-1], where=better)
        # gaps in the probe run along the row: prefix minimum of cost - column
        slope = take - span
        best = np.minimum.accumulate(slope, axis=1)
        origin = np.maximum.accumulate(np.where(slope == best, span, 0), axis=1)
        cost, start = best + span, np.take_along_axis(first, origin.astype(np.int64), axis=1)
        if i % 8 == 7:
            stay = cost.min(axis=1) <= most
            if not stay.all():
                live, cost, start, part, want = live[stay], cost[stay], start[stay], part[stay], want[stay]
                if not len(live):
                    return edits, starts, ends
    end = np.argmin(cost, axis=1)
    edits[live], starts[live], ends[live] = cost[np.arange(len(live)), end], start[np.arange(len(live)), end], end
    return edits, starts, ends


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    first, held, n = 0, [], 0
    for k, t in enumerate(texts):
        held.append(t)
        n += len(t or "")
        if n >= CHUNK_CHARS:
            yield first, held
            first, held, n = k + 1, [], 0
    if held:
        yield first, held


def _search(shared):
    names = ["_id", "item_id", "n_probes", "edits", "start", "stop"]

    def run(batches):
        probes = shared.value
        for batch in batches:
            ids, rows = batch.column(0), []
            for first, texts in _chunks(batch.column(1).to_pylist()):
                found = probes.search(texts)
                if found.shape[1]:
                    found = found[:, np.lexsort(found[::-1])]
                    new = (found[:2, 1:] != found[:2, :-1]).any(axis=0)
                    heads = np.flatnonzero(np.r_[True, new])
                    once = np.r_[True, new | (found[3:, 1:] != found[3:, :-1]).any(axis=0)]
                    low, high = (f.reduceat(found, heads, axis=1) for f in (np.minimum, np.maximum))
                    rows.append(np.stack([low[0] + first, low[1], np.add.reduceat(once.astype(np.int64), heads), low[2], low[3], high[4]]))
            if rows:
                cols = np.concatenate(rows, axis=1)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(cols[0])), *[pa.array(c) for c in cols[1:]]], names)

    return run


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, ws: Workspace, block_chars: int = BLOCK_CHARS):
    """Blocks of benchmark items of bounded size, each brought to the driver on its own; and whether it is the only one."""
    items = only(benchmark, item_col, text_col).filter(F.col(item_col).isNotNull() & F.col(text_col).isNotNull())
    items = items.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    if blocks > 1:
        items = ws.save(items, "benchmark")
    for b in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        yield sorted((r.item, r.text) for r in part.collect()), blocks == 1


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """A row per document row and benchmark item of which it holds a probe: id, item_id, n_probes, edits, start, stop.

    start and stop are places in the normalised text, edits the fewest of any probe, n_probes the places found. Null or
    empty texts on either side match nothing, as do items with a null id or without letters and digits. Items under
    SHORTEST normalised characters are met exactly and as whole words, those under Q as whole lines. A document row
    with a null id keeps the null. Repeated rows give repeated results; other columns are left out; empty tables give
    no rows.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "leaks")
    docs = only(docs, id_col, text_col)
    schema = f"_id {docs.schema[id_col].dataType.simpleString()}, item_id long, n_probes long, edits long, start long, stop long"
    out = None
    for items, alone in benchmark_blocks(benchmark, item_col, item_text_col, ws, block_chars):
        shared = spark.sparkContext.broadcast(Probes(items))
        found = docs.mapInArrow(_search(shared), schema)
        if not alone:  # one block's probes are held at a time
            found = ws.save(found, "found")
            shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out.withColumnRenamed("_id", id_col)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query: all documents against the whole benchmark."""
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def found_by_hand(text: str | None, item: str, edits: int = EDITS) -> bool:
    """Whether a text holds a probe of an item, by the edit distance of every probe to every stretch of the text."""
    t, want = normal(text), normal(item)
    if not want or not t:
        return False
    if len(want) < Q:
        return any(normal(line) == want for line in (text or "").split("\n"))
    if len(want) < SHORTEST:
        return f" {want} " in f" {t} "
    for a, b in probe_spans(len(want)):
        row = [0] * (len(t) + 1)
        for c in want[a:b]:
            last, row[0] = row[0], row[0] + 1
            for j in range(1, len(t) + 1):
                last, row[j] = row[j], min(last + (c != t[j - 1]), row[j] + 1, row[j - 1] + 1)
        if min(row) <= edit_budget(b - a, edits):
            return True
    return False
