"""Each operator against a brute-force version, and on awkward rows."""

import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import kernels as K
from tidemark.llm.decontamination import leaks, normal
from tidemark.llm.language_id import identify
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.near_dedup import intersections, near_duplicates, near_duplicates_by_hand, spanning
from tidemark.llm.packing import WordTokens, best_fit, default_vocabulary, local_search, pack
from tidemark.llm.quality_classifier import accepted_rows, classify
from tidemark.llm.quality_rules import judge, lower_quantile
from tidemark.llm.sharding import domain, shard
from tidemark.llm.substring_dedup import remove_repeats, remove_repeats_by_hand
from tidemark.llm.warc import round_trip

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(rng, n, size=40):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def corpus(seed=1, n=60):
    """Texts with exact copies, near copies, shared passages, runs, empty and null texts."""
    rng = random.Random(seed)
    passage = words(rng, 50, 400)
    texts = [None, "", "   ", "\n\n", "one", "one two three", "ha " * 80, "a b " * 50]
    for k in range(n):
        t = words(rng, rng.randrange(1, 160), rng.choice([2, 6, 300]))
        if k % 4 == 0:
            t[len(t) // 2 : len(t) // 2] = passage[rng.randrange(10) :]
        texts.append((" " if k % 3 else "\n").join(t))
    for k in range(8, 24):
        t = (texts[k] or "").split(" ")
        texts.append(" ".join(t))
        if len(t) > 20:
            t[rng.randrange(len(t))] = "changed"
            texts.append(" ".join(t))
    return texts


def docs(spark, texts, extra=True):
    rows = [(k, t, "en" if k % 2 else "fr", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    return df.withColumns({"_row": F.lit("x"), "_copy": F.lit(1), "score": F.lit(2), "n": F.lit(3), "id": F.lit(4)}) if extra else df


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def twins(n=4096):
    """Two words of n letters whose sums of powers modulo 2**64 are equal for any base and any values of the letters."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]


def test_hashes_of_twins(spark):
    import pyarrow as pa

    a, b = twins()
    w = K.words(next(K.slices(pa.array([f"{a} {b} {a.upper()}"]))), lower=True)
    assert w.hash[0] != w.hash[1] and w.hash[0] == w.hash[2]
    filler = " ".join(f"w{k}" for k in range(36))
    texts = [f"{a} {filler}", f"{b} {filler}", f"{a}\n{b}\nx y z", f"{a} one two three", f"{b} one two three"]
    out = by_id(remove_repeats(docs(spark, texts)))
    assert [(out[k].n_words, out[k].n_removed) for k in range(5)] == [w[:2] for w in remove_repeats_by_hand(texts)]
    assert by_id(judge(docs(spark, texts), spark.range(1).withColumnRenamed("id", "doc_id")))[2].n_dup_lines == 0
    assert {r.doc_id: r.component_id for r in near_duplicates(docs(spark, texts), size=4).collect()}[4] == 4


def test_text_longer_than_a_slice(spark):
    """A text of over a megabyte is taken whole by every operator that works in slices."""
    rng = random.Random(14)
    long = words(rng, 220_000, 50_000)
    item = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(16))
    texts = [" ".join(long), " ".join(long[:110_000] + ["changed"] + long[110_000:]), item, " ".join([*long[-40:], "tail"])]
    texts[0] += " " + item.upper()
    assert len(texts[0]) > K.SLICE_BYTES
    df = docs(spark, texts)
    near = by_id(near_duplicates(df, size=4))
    for k, want in near_duplicates_by_hand(list(enumerate(texts)), 4).items():
        assert (near[k].n_shingles, near[k].component_id, near[k].kept) == want
    kept = {r.doc_id: r for r in remove_repeats(df).withColumn("sha", F.sha2("kept_text", 256)).collect()}
    for k, want in enumerate(remove_repeats_by_hand(texts)):
        assert (kept[k].n_words, kept[k].n_removed, kept[k].sha) == want
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    assert {r.doc_id: (r.start, r.stop) for r in leaks(df, bench).collect()}[0] == (len(texts[0]) - len(item), len(texts[0]))
    judged = by_id(judge(df, spark.range(2).withColumnRenamed("id", "doc_id")))
    assert [judged[k].n_words for k in range(4)] == [len(t.split()) for t in texts]
    assert len({r.lang_pred for r in identify(df).collect()} - {"en", "fr"}) == 0
    assert sum(r.length for r in pack(df, default_vocabulary()).collect() if r.doc_id == 0) == 1 + len(WordTokens(default_vocabulary()).tokenizer.encode(texts[0], add_special_tokens=False).ids)


def test_shard_law(spark):
    texts = corpus()
    rows = shard(docs(spark, texts), shards=8).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    again = shard(docs(spark, texts).repartition(3), shards=8).collect()
    assert {(r.doc_id, r.position) for r in rows} == {(r.doc_id, r.position) for r in again}


@pytest.mark.parametrize("n", [1, 2, 7, 100, 999])
def test_shard_backwards(spark, n):
    from tidemark.llm.sharding import number_at, permute

    rows = spark.range(n).select("id", permute(F.col("id"), n, 20).alias("p")).select("id", "p", number_at(F.col("p") % 8, F.floor(F.col("p") / 8), n).alias("back"))
    rows = rows.collect()
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


def test_shard_by_hand(spark):
    """The permutation against one written with another library's hash."""
    import struct

    import xxhash

    from tidemark.llm.sharding import ROUNDS, permute

    def hashed(*longs, last=None):
        h = 42
        for raw in [struct.pack("<q", x) for x in longs] + ([struct.pack("<i", last)] if last is not None else []):
            h = xxhash.xxh64_intdigest(raw, seed=h)
        return h - (1 << 64) if h >= 1 << 63 else h

    def place(x, n, seed):
        a, b = domain(n)
        while True:
            left, right = x % a, x // a
            for k in range(ROUNDS):
                left = (left + hashed(right, seed * 1000 + k) % a) % a
                right = (right + hashed(left, seed * 1000 + k, last=1) % b) % b
            x = right * a + left
            if x < n:
                return x

    for n in (5, 90, 1001):
        rows = spark.range(n).select("id", permute(F.col("id"), n, 20).alias("p")).collect()
        assert {r.id: r.p for r in rows} == {x: place(x, n, 20) for x in range(n)}


def test_shard_empty_and_clashing(spark):
    df = docs(spark, ["a", None, ""]).withColumns({"shard": F.lit("x"), "slot": F.lit(1), "position": F.lit(2), "number": F.lit(3), "size": F.lit(4)})
    assert sorted(r["size"] for r in shard(df).collect()) == [1, 1, 2]
    assert shard(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1000])
def test_shard_repeated_rows_and_nulls(spark, n):
    df = spark.range(n).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    rows = shard(df).collect()
    assert sorted(r.position for r in rows) == list(range(n))
    a, b = domain(n)
    assert a * b >= n and a * b - n < a


def test_line_dedup(spark):
    rng = random.Random(3)
    pool = [f"a line that is long enough, number {k}" for k in range(12)] + ["short", "", "  A LINE that is long enough, number 3\t"]
    texts = [None, ""] + ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    key = lambda x: re.sub("[A-Z]+", lambda m: m[0].lower(), x.strip(" \t\n\v\f\r"))
    holders = collections.defaultdict(set)
    for k, t in enumerate(texts):
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                holders[key(x)].add(k)
    out = by_id(dedup_lines(docs(spark, texts), batches=3, fanout=2))
    assert len(out) == len(texts)
    for k, t in enumerate(texts):
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (len(holders[key(x)]) >= 3 and max(holders[key(x)]) > k)]
        assert (out[k].n_lines, out[k].n_dropped, out[k].kept_text) == (len(lines), len(lines) - len(keep), "\n".join(keep))
        assert out[k]["_row"] == "x"


def test_line_dedup_awkward_ids(spark):
    line = "a line that is long enough"
    df = spark.createDataFrame([(None, line), (1, line), (1, line), (2, line), (2, line)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_dropped) for r in dedup_lines(df).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (2, 0), (2, 0)]
    assert dedup_lines(df.limit(0)).count() == 0


def test_line_runs_opened_again(spark):
    """Batches through one store, and through one that is opened anew before each batch: the same runs."""
    from tidemark.llm.line_dedup import LineRuns, line_keys
    from tidemark.llm.workspace import Workspace

    rng = random.Random(6)
    texts = ["\n".join(f"a line that is long enough, {rng.randrange(15)}" for _ in range(4)) for _ in range(40)]
    keys = line_keys(docs(spark, texts), "doc_id", "text").cache()
    one, state = LineRuns(Workspace(spark, "one")), []
    for low in (30, 20, 10, 0):
        batch = keys.filter(f"doc_id >= {low} AND doc_id < {low + 10}")
        one.add(batch, "doc_id")
        again = LineRuns.open(Workspace(spark, "again"), state)
        again.add(batch, "doc_id")
        state = again.state()
    assert [level for level, _ in state] == [level for level, _ in one.state()]
    assert sorted(one.merged().collect()) == sorted(again.merged().collect())


@pytest.mark.parametrize("seed", range(3))
def test_substring_dedup(spark, seed):
    texts = corpus(seed)
    out = {r["doc_id"]: r for r in remove_repeats(docs(spark, texts)).withColumn("sha", F.sha2("kept_text", 256)).collect()}
    for k, want in enumerate(remove_repeats_by_hand(texts)):
        assert (out[k].n_words, out[k].n_removed, out[k].sha) == want


@pytest.mark.parametrize("seed", range(2))
def test_substring_dedup_small_alphabet(spark, seed):
    rng = random.Random(100 + seed)
    texts = [" ".join(words(rng, rng.randrange(0, 120), rng.choice([1, 2, 3, 5]))) for _ in range(60)]
    for window in (8, 12, 20, 35):
        out = {r["doc_id"]: r for r in remove_repeats(docs(spark, texts), window=window).collect()}
        for k, want in enumerate(remove_repeats_by_hand(texts, window)):
            assert (out[k].n_words, out[k].n_removed) == want[:2]


def test_every_repeated_window_is_a_candidate():
    """Passages with runs of all lengths at their ends, over small and large alphabets."""
    import numpy as np
    import pyarrow as pa

    from tidemark.llm.substring_dedup import anchors

    for seed in range(150):
        rng = random.Random(seed)
        window, alphabet = rng.choice([8, 12, 20, 35, 35]), rng.choice([2, 3, 5, 20, 200])
        base = words(rng, window + rng.randrange(40), alphabet)
        texts = []
        for _ in range(12):
            t = words(rng, rng.randrange(0, 60), alphabet)
            b = base[rng.randrange(0, len(base) // 2) :]
            b = [b[0]] * rng.randrange(0, 4) + b + [b[-1]] * rng.randrange(0, 4)
            at = rng.randrange(len(t) + 1)
            t[at:at] = b if rng.random() < 0.7 else []
            texts.append(" ".join(t))
        w = K.words(next(K.slices(pa.array(texts))))
        starts, key, place, at_end = anchors(w, window)
        if not len(starts):
            continue
        content = K.windows(w, window)[0].tolist()
        count = collections.Counter(content)
        places = collections.defaultdict(set)
        for k, p in zip(key.tolist(), place.tolist()):
            places[k].add(p)
        candidate = at_end | np.array([len(places[k]) > 1 for k in key.tolist()])
        assert all(c or count[x] == 1 for c, x in zip(candidate, content))


def test_substring_dedup_repeated_ids(spark):
    t = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([(1, t), (1, t), (None, "x y"), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_words, r.n_removed) for r in remove_repeats(df).collect()))
    assert got == [(0, 0, 0), (0, 2, 0), (1, 40, 40), (1, 40, 40)]
    assert remove_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_near_duplicates(spark, seed):
    texts = corpus(10 + seed, 40)
    rng = random.Random(seed)
    base = words(rng, 60, 500)
    for _ in range(30):
        t = list(base)
        for _ in range(rng.randrange(0, 5)):
            t[rng.randrange(len(t))] = f"x{rng.randrange(1000)}"
        texts.append(" ".join(t))
    out = by_id(near_duplicates(docs(spark, texts), size=4))
    for k, want in near_duplicates_by_hand(list(enumerate(texts)), 4).items():
        assert (out[k].n_shingles, out[k].component_id, out[k].kept) == want


def test_near_duplicates_large_nodes(spark, monkeypatch):
    """With tiny limits every node is large: leaders, branching and the second look give the same components."""
    import tidemark.llm.near_dedup as N

    monkeypatch.setattr(N, "SMALL", 6)
    monkeypatch.setattr(N, "PAIRS", 0)
    rng = random.Random(5)
    texts = []
    for g in range(3):
        base = words(rng, 70, 500)
        for _ in range(25):
            t = list(base)
            for _ in range(rng.randrange(0, 4)):
                t[rng.randrange(len(t))] = f"x{rng.randrange(1000)}"
            texts.append(" ".join(t))
    out = by_id(near_duplicates(docs(spark, texts), size=4))
    for k, want in near_duplicates_by_hand(list(enumerate(texts)), 4).items():
        assert (out[k].n_shingles, out[k].component_id, out[k].kept) == want


def test_near_duplicates_linked_families(spark, monkeypatch):
    """Families that settle in one large node and are linked by one pair: pairs across them are compared too."""
    from tidemark.llm import near_dedup as N

    monkeypatch.setattr(N, "SMALL", 20)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(400)]
    texts = []
    for f in range(2):  # of all pairs across the two families only that of their unchanged texts reaches 0.8
        texts.append(" ".join(base))
        for k in range(40):
            t = list(base)
            t[10 * k + 5] = f"m{len(texts)}"
            texts.append(" ".join(t))
        for k in range(11):
            base[30 * k + 10] = f"other{k}"
    rng.shuffle(texts)
    out = by_id(near_duplicates(docs(spark, texts), size=4))
    want = near_duplicates_by_hand(list(enumerate(texts)), 4)
    assert len({w[1] for w in want.values()}) == 1
    for k, w in want.items():
        assert (out[k].n_shingles, out[k].component_id, out[k].kept) == w


def test_near_duplicates_awkward_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (1, "a b c d e"), (1, "q r s t u"), (7, "q r s t u"), (9, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in near_duplicates(df, size=4).collect())
    assert got == [(0, None, True), (1, 1, True), (1, 1, True), (3, 1, False), (7, 1, False), (9, 9, True)]
    assert near_duplicates(df.limit(0)).count() == 0


def test_intersections_and_spanning():
    import numpy as np

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, rng.integers(0, 300))).astype(np.uint64) for _ in range(25)]
    got = intersections(sets[:10], sets[10:])
    assert all(got[i, j] == len(set(sets[i].tolist()) & set(sets[10 + j].tolist())) for i in range(10) for j in range(15))
    a, b = rng.integers(0, 40, (2, 60))
    chosen = spanning(40, a, b, rng.random(60))

    def groups(edges):
        label = list(range(40))
        for x, y in edges:
            label = [label[x] if k == label[y] else k for k in label]
        return {frozenset(i for i in range(40) if label[i] == k) for k in label}

    assert groups(zip(a, b)) == groups(zip(a[chosen], b[chosen])) and len(chosen) == 40 - len(groups(zip(a, b)))


@pytest.mark.parametrize("small", [8, 40, 1024])
def test_near_duplicates_one_link_between_clusters(spark, monkeypatch, small):
    """Two clusters whose bases are just not similar enough, and one pair across them that is, in one dense node."""
    from tidemark.llm import near_dedup as N

    monkeypatch.setattr(N, "SMALL", small)
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "PAIRS", 0 if small == 8 else N.PAIRS)
    rng = random.Random(7)
    base = [f"w{k}" for k in range(400)]
    far = list(base)
    for k in range(12):
        far[31 * k + 9] = f"other{k}"
    texts = []
    for b in (base, far):
        for k in range(60):
            t = list(b)
            t[rng.randrange(400)] = f"m{len(texts)}"
            texts.append(t)
    middle = list(far)
    middle[9] = base[9]  # closer to the other base by one place
    texts += [base, middle]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    want = near_duplicates_by_hand(rows, 4)
    out = by_id(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=4))
    for k, w in want.items():
        assert (out[k].n_shingles, out[k].component_id, out[k].kept) == w


def test_near_duplicates_recall(spark):
    """Pairs just above the threshold: at most one in a thousand may be lost."""
    rng = random.Random(8)
    rows, pairs = [], []
    for p in range(1500):
        t = [f"v{p}x{k}" for k in range(100)]
        u = list(t)
        for k in rng.sample(range(1, 23), 2):  # each change takes four shingles: 89 of 105 in common, or one less
            u[4 * k + 1] = f"c{p}"
        u = u[:-1] if p % 2 else u
        a, b = (set(zip(x, x[1:], x[2:], x[3:])) for x in (t, u))
        assert 0.8 <= len(a & b) / len(a | b) <= 0.86
        rows += [(2 * p, " ".join(t)), (2 * p + 1, " ".join(u))]
    out = by_id(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), size=4))
    assert sum(out[2 * p + 1].component_id == 2 * p for p in range(1500)) >= 1499


def test_leaks(spark):
    rng = random.Random(9)
    items = [" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n)) for n in (12, 20, 45, 70)]
    filler = lambda n: " ".join("".join(rng.choice("klmnopqrst") for _ in range(5)) for _ in range(n))
    typo = list(items[2])
    for at in (30, 80, 130):
        typo[at] = "z"
    texts = [None, "", filler(40), f"{filler(9)} {items[0].upper()} {filler(4)}", f"{filler(3)}\n{items[3]}", f"{filler(3)} {''.join(typo)} {filler(3)}", items[1].replace(" ", "\n")]
    bench = spark.createDataFrame([*enumerate(items), (9, None), (10, ""), (11, "x"), (None, items[0])], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(docs(spark, texts), bench).collect()}
    assert got == {(3, 0), (4, 3), (5, 2), (6, 1)}
    blocks = {(r.doc_id, r.item_id) for r in leaks(docs(spark, texts), bench, block_chars=100).collect()}
    assert blocks == got
    assert leaks(docs(spark, texts), bench.limit(0)).count() == 0
    assert normal(" A,\t--b_c\n") == "a b c"


def edited(rng, text, k):
    """k edits that can't undo each other, four characters apart."""
    places = rng.sample(range(1, len(text) // 4), k)
    t = list(text)
    for p in sorted(places, reverse=True):
        kind, at = rng.randrange(3), 4 * p
        if kind == 0:
            t[at] = "9"
        elif kind == 1:
            del t[at]
        else:
            t.insert(at, "8")
    return "".join(t)


def test_leaks_by_hand():
    """Probes.search() finds what the edit distances of all probes say, at budgets met and missed by one."""
    from tidemark.llm.decontamination import PROBE, Probes, edit_budget, found_by_hand

    rng = random.Random(12)
    say = lambda n, letters="abcdefgh": " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(n))
    items = [say(30)[:160].strip(), say(14)[:PROBE - 1], say(9)[:45].strip(), "short one, here", "No!", say(60), "the answer"]
    texts = [None, "", "!!", "no", "x\nNO\n y", "no way", "bathe answered quietly", "so The  Answer", "a short one here b", "a short one herex"]
    for item in items[:3] + items[5:6]:
        k = edit_budget(min(len(item), PROBE))
        for extra in (0, 1, 2):
            part = normal(item)[:PROBE]
            texts.append(f"{say(5, 'mnopq')} {edited(rng, part, k + extra)} {say(5, 'mnopq')}")
        texts.append(f"{say(3, 'mnopq')} {item[10:]} ")
        texts.append(item[: len(item) // 2])
    rows = Probes(list(enumerate(items))).search(texts).T.tolist()
    found = {(t, i) for t, i, *_ in rows}
    want = {(t, i) for t, text in enumerate(texts) for i, item in enumerate(items) if found_by_hand(text, item)}
    assert found == want and len(want) >= 12
    for t, i, _, a, b in rows:
        assert 0 <= a < b <= len(normal(texts[t]))


def test_leaks_common_stem():
    """Many items that begin alike, and a text that repeats the beginning: bounded work."""
    import time
    import tracemalloc

    from tidemark.llm.decontamination import Probes

    rng = random.Random(13)
    stem = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(10))[:69]
    items = [(k, stem + " " + " ".join("".join(rng.choice("ijklmnop") for _ in range(7)) for _ in range(9))) for k in range(3000)]
    probes = Probes(items)
    tracemalloc.start()
    began = time.time()
    found = probes.search([" ".join([stem] * 300), items[7][1]]).T.tolist()
    assert time.time() - began < 30 and tracemalloc.get_traced_memory()[1] < 400e6
    tracemalloc.stop()
    assert {i for t, i, *_ in found if t == 1} >= {7}


def test_packing(spark):
    from tokenizers import Tokenizer

    texts = corpus() + ["It's 12345 §x ÀÉ×÷ß 'quoted's \x1c z\x85y", "plain <|endoftext|> words", *twins(), "日本語 Σας é", "word " * 9000]
    t = Tokenizer.from_file(default_vocabulary())
    want = {k: [*t.encode(x or "", add_special_tokens=False).ids, 1] for k, x in enumerate(texts)}
    rows = pack(docs(spark, texts), default_vocabulary(), group=50).collect()
    seen = collections.Counter()
    for r in rows:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert r.start == 4096 * r.piece and len(ids) == r.length
        assert zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)) == r.ids_crc32
        seen[r.doc_id] += r.length
    assert seen == {k: len(v) for k, v in want.items()}
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= -(-sum(map(len, want.values())) // 4096) + 1
    assert pack(docs(spark, texts).limit(0), default_vocabulary()).count() == 0


def test_local_search_improves():
    import numpy as np

    rng = np.random.default_rng(1)
    sizes = rng.integers(1000, 2600, 60)
    first = best_fit(sizes, 4096)
    bins = local_search(sizes, first, 4096)
    assert np.bincount(bins, sizes).max() <= 4096
    assert len(set(bins.tolist())) <= len(set(first.tolist()))


def test_word_tokens_of_other_rules():
    import public_tokenizers
    import pyarrow as pa

    w = WordTokens(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("Some Plain words, 123", "more\n\nText  here"):
        assert w.encode(next(K.slices(pa.array([text]))))[0].tolist() == w.tokenizer.encode(text, add_special_tokens=False).ids


def test_word_tokens_forget():
    import pyarrow as pa

    w = WordTokens(default_vocabulary(), most=10)
    for _ in range(2):
        for text in ("alpha beta gamma", "delta epsilon", "one two three four five six seven eight nine ten eleven"):
            got = w.encode(next(K.slices(pa.array([text]))))[0].tolist()
            assert got == w.tokenizer.encode(text, add_special_tokens=False).ids


def labelled(spark, n=300):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(n):
        kind = k % 5
        t = words(rng, 40, 200)
        if kind == 0:
            t = [x + "!!" for x in t]
        if kind == 1:
            t[3] = "awful"
        rows.append((k, " ".join(t), "en", f"s{k % 7}", 1))
        if k % 2:
            labels.append((k, int(kind != 0), int(kind == 1)))
    rows += [(n, None, None, None, None), (n + 1, "", "en", "s1", 0), (None, "a b", "en", "s1", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_classifier(spark):
    df, labels = labelled(spark)
    out = [r for r in classify(df.withColumn("extra", F.lit(1)), labels).collect()]
    assert len(out) == df.count() and all(0 <= r.score <= 1 for r in out)
    judged = [(r.accepted, r.doc_id % 5 > 1) for r in out if r.doc_id is not None and r.doc_id < 300]
    assert sum(a == b for a, b in judged) / len(judged) > 0.95
    kept = {r.doc_id for r in accepted_rows(df, labels).collect()}
    assert kept == {r.doc_id for r in out if r.accepted}
    assert {r.score for r in classify(df, labels.limit(0)).collect()} == {0.5}


def test_one_id_on_many_rows(spark):
    """A labelled id that many rows repeat counts once; ties of scores and copies get equal verdicts."""
    df, labels = labelled(spark, 100)
    many = spark.range(10_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("same words "), F.col("id") % 50).alias("text"), F.lit("en").alias("lang"), F.lit("s1").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    out = classify(df.unionByName(many), labels)
    assert out.count() == df.count() + 10_000
    found = identify(df.unionByName(many))
    assert found.count() == df.count() + 10_000 and {r.lang_pred for r in found.filter("doc_id < 100").collect()} == {"en"}
    copies = classify(df.filter("doc_id = 7").unionByName(df.filter("doc_id = 7").withColumn("doc_id", F.lit(5000).cast("long"))), labels).collect()
    assert len({(r.score, r.accepted) for r in copies}) == 1
    assert classify(df.limit(0), labels).count() == 0
    named = df.withColumns({"accepted": F.lit(1), "y": F.lit(2), "_key": F.lit(3), "_row": F.lit(4), "labelled": F.lit(5)})
    assert classify(named, labels.withColumn("score", F.lit(1))).count() == df.count()


def test_quality_rules_by_hand(spark):
    """The verdict from counts of the words themselves."""
    import math

    rng = random.Random(21)
    texts = [" ".join(rng.choice([f"w{k}" for k in range(25)][(j % 3) * 5 :]) for _ in range(rng.randrange(8, 60))) for j in range(150)]
    trusted = spark.range(0, 150, 3)
    hashed = F.xxhash64(F.col("id"))
    held = {r.id: r.h for r in trusted.select("id", (F.pmod(F.shiftright(hashed, 20), F.lit(2)) == 0).alias("h")).collect()}
    grams = lambda t, n: [tuple(t.split()[i : i + n]) for i in range(len(t.split()) - n + 1)]
    score = [{}, {}]
    least = []
    for n in (1, 2):
        raw = collections.Counter(g for t in texts for g in grams(t, n))
        target = collections.Counter(g for k, t in enumerate(texts) if held.get(k) is False for g in grams(t, n))
        share = sum(target.values()) / sum(raw.values())
        ratio = {g: math.log((target[g] + 3) / (raw[g] * share + 3)) for g in raw}
        score[n - 1] = {k: sum(ratio[g] for g in grams(t, n)) / math.sqrt(max(1, len(grams(t, n)))) for k, t in enumerate(texts)}
        least.append(min(score[n - 1][k] for k, h in held.items() if h))
    out = by_id(judge(docs(spark, texts), trusted.withColumnRenamed("id", "doc_id"), bits=20))
    clear = [k for k in out if min(abs(score[n][k] - least[n]) for n in (0, 1)) > 1e-4]
    assert len(clear) > 120 and 20 < sum(out[k].kept for k in clear) < len(clear)
    for k in clear:
        assert out[k].kept == (not out[k].base_failed and all(score[n][k] >= least[n] for n in (0, 1)))
        assert abs(out[k].margin - min(score[n][k] - least[n] for n in (0, 1))) < 1e-3


def test_quality_rules_use_all_trusted(spark):
    """52 000 trusted documents: words that only those with the largest hashes of their ids hold count like all others."""
    import math

    n, common = 52_000, "a b c d e f g h i j k l"
    ids = [r.id for r in spark.range(n).orderBy(F.xxhash64("id"), "id").collect()]
    kind = {k: f"early e{k % 5}" for k in ids[:50_000]} | {k: f"late l{k % 5}" for k in ids[50_000:]}
    kind |= {k: f"other o{k % 5}" if k % 2 else f"late l{k % 5}" for k in range(n, n + 3000)}
    texts = {k: f"{common} {v}" for k, v in kind.items()}
    trusted = spark.range(n).withColumnRenamed("id", "doc_id")
    hashed = trusted.select("doc_id", (F.pmod(F.shiftright(F.xxhash64("doc_id"), 20), F.lit(2)) == 0).alias("h"))
    held = {r.doc_id: r.h for r in hashed.collect()}
    grams = lambda t, size: list(zip(*[t.split()[i:] for i in range(size)]))
    score, least = [], []
    for size in (1, 2):
        raw, target = collections.Counter(), collections.Counter()
        for t, count in collections.Counter(texts.values()).items():
            raw.update({g: count for g in grams(t, size)})
        for t, count in collections.Counter(texts[k] for k, h in held.items() if not h).items():
            target.update({g: count for g in grams(t, size)})
        share = sum(target.values()) / sum(raw.values())
        ratio = {g: math.log((target[g] + 3) / (raw[g] * share + 3)) for g in raw}
        of = {t: sum(ratio[g] for g in grams(t, size)) / math.sqrt(len(grams(t, size))) for t in set(texts.values())}
        score.append(of)
        least.append(min(of[texts[k]] for k, h in held.items() if h))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    out = judge(df, trusted).collect()
    assert len(out) == len(texts)
    assert all(abs(r.margin - min(score[k][texts[r.doc_id]] - least[k] for k in (0, 1))) < 1e-3 for r in out)


def test_quality_rules_blocks(spark):
    """Trusted ids in many blocks, repeated, unknown and null ones among them: as in one block."""
    df = docs(spark, corpus()).unionByName(docs(spark, ["no id at all"]).withColumn("doc_id", F.lit(None).cast("long")))
    trusted = spark.createDataFrame([(k,) for k in [*range(40), 3, 3, 10**6, None]], "doc_id long")
    one = sorted((r.doc_id or -1, r.kept, r.margin) for r in judge(df, trusted).collect())
    assert one == sorted((r.doc_id or -1, r.kept, r.margin) for r in judge(df, trusted, trusted_block=7).collect())
    assert len(one) == df.count()


def test_threshold_is_exact(spark):
    """Of many scores the value of its exact rank, not that of a sketch."""
    values = spark.range(60_000).select(F.pmod(F.xxhash64("id"), F.lit(10**12)).cast("double").alias("s")).repartition(6)
    known = sorted(r.s for r in values.collect())
    assert [lower_quantile(values, "s", q) for q in (0.005, 0.0, 1.0)] == [known[299], known[0], known[-1]]
    assert lower_quantile(values.limit(0), "s", 0.005) is None


def test_quality_rules_edges(spark):
    df = docs(spark, ["a b c d e f g h i j k l"] * 2 + [None, ""]).withColumns({"kept": F.lit(1), "_target": F.lit(2), "_held": F.lit(3), "margin": F.lit(4)})
    rows = judge(df, spark.range(0, 2).withColumnRenamed("id", "doc_id")).collect()
    assert len(rows) == 4 and len({(r.kept, r.margin) for r in rows if r.doc_id < 2}) == 1
    assert judge(df.limit(0), spark.range(0, 2).withColumnRenamed("id", "doc_id")).count() == 0
    assert [r.kept for r in judge(df, spark.range(0).withColumnRenamed("id", "doc_id")).orderBy("doc_id").collect()] == [True, True, False, False]


def test_quality_rules(spark):
    texts = corpus() + ["same line here\nsame line here\n \n \nother # * $ % & | < >", "x " * 30]
    trusted = spark.range(0, 40).select(F.col("id").alias("doc_id"))
    out = by_id(judge(docs(spark, texts), trusted))
    for k, t in enumerate(texts):
        t = t or ""
        w = WORD.findall(t)
        count = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        again = {j for i in range(len(w) - 4) if count[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again))
        r = out[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        assert r.base_failed == failed and not (failed and r.kept)


def test_language_id(spark):
    rng = random.Random(4)
    parts = {"en": ["the", "ing", "and", "er", "tion"], "de": ["sch", "ung", "ein", "ch", "ü"], "fr": ["eau", "que", "é", "ou", "ment"]}
    rows = []
    for k in range(240):
        lang = rng.choice(sorted(parts))
        rows.append((k, " ".join("".join(rng.choices(parts[lang], k=2)) for _ in range(30)), lang, "s", 1))
    rows += [(900, None, None, "s", 0), (901, "12 34 !!", "en", "s", 0), (None, "the and", "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = identify(df).collect()
    assert len(out) == len(rows)
    lang = {r[0]: r[2] for r in rows}
    held = [r for r in out if r.held_out and r.doc_id < 900]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out if r.doc_id is not None)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97
    assert {r.lang_pred for r in out if r.doc_id in (900, 901)} == {"und"}
    assert identify(df.limit(0)).count() == 0


def test_language_ties(spark):
    """Two languages with the same texts: the one that sorts first."""
    rows = [(k, "one and the same text", "bb" if k % 2 else "aa") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in identify(df).collect()} == {"aa"}


def test_warc(spark):
    import base64
    import hashlib

    html = ["<p>a</p>", None, "", "<p>a</p>", "é" * 5000, "<p>a</p>", "x\r\n\r\ny"]
    rows = [(k + 1, None if k == 2 else f"http://h/{k} é", h, k) for k, h in enumerate(html)] + [(None, "u", "<p>a</p>", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n int")
    out = {r.page_id: r for r in round_trip(df).collect()}
    assert len(out) == len(rows)
    first = {}
    for k, h in enumerate(html):
        raw = (h or "").encode()
        r = out[k + 1]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        seen = first.setdefault(raw, k + 1)
        assert (r.record_type, r.refers_to) == (("response", None) if seen == k + 1 else ("revisit", seen))
    assert out[None].record_type == "response"
    named = df.withColumns({"refers_to": F.lit(1), "_sha": F.lit(2), "record_type": F.lit(3), "file": F.lit(4)})
    assert round_trip(named).count() == len(rows)
    assert round_trip(df.limit(0)).count() == 0
