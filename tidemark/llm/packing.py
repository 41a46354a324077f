"""Packing of token pieces into sequences of bounded length by swap-based local search.

Texts become tokens and pieces in one pass. Pieces are dealt by hash into groups of about GROUP pieces; a task packs
one group: best fit first, then moves, one-for-one and two-for-one exchanges between underfull bins, each of which
increases the sum of squared fills, until bins empty. Bins that stay underfull give their pieces to a second round.
"""

from __future__ import annotations

import bisect
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .workspace import Workspace, only

LENGTH = 4096
END_ID = 1
GROUP = 3000
#: Bins with more room than this go to the second round.
ROOM = 16
#: Words whose tokens a worker keeps, about 40 bytes each.
MOST_WORDS = 1_500_000
VOCABULARY = "word_bpe_49k.json"


_DIGIT, _OTHER = 3, 2
#: Classes of bytes in plain texts: 0 white space, 1 letters, 2 others, 3 digits.
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = _DIGIT
#: Lower case of A-Z, and of the second bytes of the capitals from U+00C0 on.
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_SMALL[0x80:0x9F] += 32
#: Leading bytes other than 0xC3 and the apostrophe, which takes part in contractions, make a text not plain.
_STRANGE = np.zeros(256, bool)
_STRANGE[[ord("'"), 0xC2, *range(0xC4, 0x100)]] = True


def plain_texts(part: K.Slice) -> np.ndarray:
    """Which texts hold only ASCII and letters of U+00C0 to U+00FF, and no apostrophe.

    The vocabulary's rules part such a text into runs of letters, single digits and runs of other characters, all of
    them on their own; normalising is lower case alone.
    """
    data = part.data
    bad = _STRANGE[data]
    # U+00D7 and U+00F7 aren't letters
    sign = np.zeros(len(data), bool)
    sign[1:] = (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    total = np.concatenate([[0], np.cumsum(bad | sign)])
    return total[part.offsets[1:]] == total[part.offsets[:-1]]


#: Rules under which plain texts part into words on their own (fixed values, as tokenizer files state them).
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _parts_words(rules: dict) -> bool:
    """Whether a tokenizer normalises and splits by exactly these rules, with a BPE model that ends words by </w>."""
    split = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    return (
        (rules["normalizer"] or {}).get("normalizers") == _NORMALIZERS and len(split) == 2 and split[0].get("pattern") == {"Regex": _SPLIT}
        and split[0].get("behavior") == "Removed" and split[0].get("invert") is True and split[1].get("type") == "ByteLevel"
        and not split[1].get("add_prefix_space") and not split[1].get("use_regex") and rules["model"].get("end_of_word_suffix") == "</w>"
        and not rules["model"].get("dropout")
    )


class WordTokens:
    """Tokens of texts, with the tokens of words kept from earlier texts.

    Words of plain texts are looked up by a hash of 64 bits; only new ones go through the tokenizer. All other texts go
    through it whole, as do those that hold an added token, and all texts where the tokenizer's rules are others.
    """

    def __init__(self, path: str, most: int = MOST_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.by_words = _parts_words(json.loads(self.tokenizer.to_str()))
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._reset()

    def _reset(self) -> None:
        self.hash, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.lengths, self.ids = (np.zeros(1024, t) for t in (np.int64, np.int32, np.uint32))
        self.n = self.used = 0

    def _tokens(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each has."""
        joined = [" ".join(words[k : k + 500]) for k in range(0, len(words), 500)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
        at = np.flatnonzero(self.ends[ids])
        if len(at) == len(words) and at[-1] == len(ids) - 1:
            return ids, np.diff(np.r_[-1, at])
        each = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        return np.array([i for e in each for i in e], np.uint32), np.array([len(e) for e in each])

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        ids, lengths = self._tokens(words)
        for name, more in (("starts", self.n + len(words)), ("lengths", self.n + len(words)), ("ids", self.used + len(ids))):
            have = getattr(self, name)
            if more > len(have):
                setattr(self, name, np.concatenate([have, np.zeros(max(more - len(have), len(have)), have.dtype)]))
        self.starts[self.n : self.n + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.n : self.n + len(words)] = lengths
        self.ids[self.used : self.used + len(ids)] = ids
        at = np.searchsorted(self.hash, hashes)
        self.hash, self.number = np.insert(self.hash, at, hashes), np.insert(self.number, at, self.n + np.arange(len(words)))
        self.n, self.used = self.n + len(words), self.used + len(ids)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hash, hashes)
        at[at == len(self.hash)] = 0
        return (self.hash[at] == hashes if len(self.hash) else np.zeros(len(hashes), bool)), at

    def encode(self, part: K.Slice) -> list[np.ndarray]:
        """Token ids of each text of a slice."""
        plain = plain_texts(part) & self.by_words
        raw = part.data.tobytes()
        for token in self.added:  # their strings are tokens of their own
            at = raw.find(token)
            while at >= 0:
                plain[np.searchsorted(part.offsets, at, "right") - 1] = False
                at = raw.find(token, at + 1)
        data = _SMALL[part.data]
        kind = _CLASS[part.data]
        edge = kind == _DIGIT
        edge[1:] |= (kind[1:] != kind[:-1]) | edge[:-1]
        w = K.words(K.Slice(part.first, data, part.offsets), _CLASS, cuts=edge)
        use = plain[w.text]
        unique, inverse = np.unique(w.hash[use], return_inverse=True)
        if self.n + len(unique) > self.most:
            self._reset()
        known, at = self._find(unique)
        if not known.all():
            place = np.zeros(len(unique), np.int64)
            place[inverse] = np.flatnonzero(use)
            small = data.tobytes()
            new = place[~known]
            self._learn(unique[~known], [small[a:b].decode() for a, b in zip(w.start[new].tolist(), w.end[new].tolist())])
            _, at = self._find(unique)
        number = self.number[at][inverse] if len(unique) else np.zeros(0, np.int64)
        lengths = self.lengths[number].astype(np.int64)
        ends = np.cumsum(lengths)
        flat = self.ids[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[number] - (ends - lengths), lengths)]
        sizes = np.bincount(w.text[use], lengths, len(part)).astype(np.int64)
        out = np.split(flat, np.cumsum(sizes)[:-1])
        rest = np.flatnonzero(~plain)
        if len(rest):
            texts = [raw[part.offsets[k] : part.offsets[k + 1]].decode() for k in rest]
            for k, e in zip(rest, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                out[k] = np.array(e.ids, np.uint32)
        return out


def _cutter(path: str, length: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, row = WordTokens(path), 0
        for batch in batches:
            for part in K.slices(batch.column(1)):
                which, piece, start, size, crc, rows = [], [], [], [], [], []
                for k, ids in enumerate(tokens.encode(part)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for p in range(0, len(ids), length):
                        cut = ids[p : p + length]
                        which.append(part.first + k), piece.append(p // length), start.append(p), size.append(len(cut))
                        crc.append(zlib.crc32(cut.tobytes())), rows.append(row)
                    row += 1
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                cols = [pa.array(c, t) for c, t in zip((piece, start, size, crc, rows), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which, pa.int64())), *cols], ["_id", "piece", "start", "length", "ids_crc32", "_row"])

    return run


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each piece: largest first, each into the fullest bin that has room."""
    bins = np.zeros(len(sizes), np.int64)
    rooms: list[tuple[int, int]] = []
    made = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        at = bisect.bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            room, b, made = capacity, made, made + 1
        bins[i] = b
        if room > size:
            bisect.insort(rooms, (room - size, b))
    return bins


def local_search(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Improve bins: empty the emptiest underfull bin by moves and exchanges, until none helps or the bound is reached.

    Every step takes tokens out of that bin into one at least as full, so the sum of squared fills grows and the search
    ends. All pieces of the bin and all pairs of them are considered.
    """
    bins = bins.copy()
    if not len(sizes):
        return bins
    fill = np.bincount(bins, sizes).astype(np.int64)
    bound, live = -(-int(sizes.sum()) // capacity), int((fill > 0).sum())
    stuck = np.zeros(len(fill), bool)
    while live > bound:
        open_bins = np.flatnonzero((fill > 0) & (fill < capacity) & ~stuck)
        if not len(open_bins):
            break
        low = int(open_bins[np.argmin(fill[open_bins])])
        mine = np.flatnonzero(bins == low)
        room = np.where(fill >= fill[low], capacity - fill, -1)
        room[low] = -1
        one, count = np.unique(sizes[mine], return_counts=True)
        done = False
        # move: the largest piece that fits anywhere, into the fullest bin
        fits = one[one <= room.max()]
        if len(fits):
            size = int(fits[-1])
            b = int(np.argmin(np.where(room >= size, room, capacity + 1)))
            bins[mine[sizes[mine] == size][0]] = b
            fill[b], fill[low], done = fill[b] + size, fill[low] - size, True
        else:
            # one or two of mine for one piece of a bin with room, with the largest gain that fits
            i, j = np.triu_indices(len(one))
            ok = (i != j) | (count[i] > 1)
            i, j = np.r_[np.arange(len(one)), i[ok]], np.r_[np.full(len(one), -1), j[ok]]
            give = one[i] + np.where(j >= 0, one[j], 0)
            order = np.argsort(give, kind="stable")
            give = give[order]
            others = np.flatnonzero(room[bins] > 0)
            if len(others):
                at = np.searchsorted(give, sizes[others] + room[bins[others]], "right") - 1
                gain = np.where(at >= 0, give[at] - sizes[others], 0)
                k = int(np.argmax(gain))
                if gain[k] > 0:
                    b, e = int(bins[others[k]]), int(order[at[k]])
                    first = mine[sizes[mine] == one[i[e]]]
                    taken = [first[0]]
                    if j[e] >= 0:
                        taken.append(first[1] if i[e] == j[e] else mine[sizes[mine] == one[j[e]]][0])
                    bins[taken], bins[others[k]] = b, low
                    fill[b], fill[low], done = fill[b] + gain[k], fill[low] - gain[k], True
        if not done:
            stuck[low] = True
        elif fill[low] == 0:
            live -= 1
            stuck[:] = False
    return bins


def _pack(level: int, capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_id", "piece", "ids_crc32", "_row"], na_position="first", kind="stable").reset_index(drop=True)
        sizes = pdf["length"].to_numpy(np.int64)
        bins = local_search(sizes, best_fit(sizes, capacity), capacity)
        order = np.argsort(bins, kind="stable")
        pdf = pdf.iloc[order].reset_index(drop=True)
        sizes, bins = sizes[order], np.unique(bins[order], return_inverse=True)[1]
        ends = np.cumsum(sizes)
        first = np.r_[True, bins[1:] != bins[:-1]]
        pdf["offset"] = ends - sizes - np.maximum.accumulate(np.where(first, ends - sizes, 0))
        pdf["room"] = capacity - np.bincount(bins, sizes).astype(np.int64)[bins]
        pdf["sequence_id"] = (np.int64(level) << 56) + (pdf["_group"].to_numpy(np.int64) << 16) + bins
        return pdf

    return run


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    end_id: int = END_ID, group: int = GROUP,
) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, sequence_id and offset.

    Null or empty text: the end id alone. Repeated rows and rows with null ids are packed like any others. Other
    columns are left out. An empty table gives no rows. Sequence numbers hold the round, the group and the bin.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "packing")
    id_type = docs.schema[id_col].dataType.simpleString()
    base = f"_id {id_type}, piece int, start long, length long, ids_crc32 long, _row long"
    pieces = ws.save(only(docs, id_col, text_col).mapInArrow(_cutter(vocabulary, length, end_id), base), "pieces")
    schema = base + ", _group long, offset long, room long, sequence_id long"

    def dealt(rows: DataFrame, n: int, level: int) -> DataFrame:
        groups = max(1, -(-n // group))
        key = F.pmod(F.xxhash64("_id", "piece", "ids_crc32", "_row", F.lit(level)), F.lit(groups))
        return rows.withColumn("_group", key).groupBy("_group").applyInPandas(_pack(level, length), schema)

    names = [c.split()[0] for c in base.split(", ")]
    first = ws.save(dealt(pieces, pieces.count(), 1), "packed")
    rest = first.filter(F.col("room") > ROOM).select(*names)
    second = dealt(rest, rest.count(), 2)
    out = first.filter(F.col("room") <= ROOM).unionByName(second)
    return out.select(F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query: all documents in sequences of at most 4096 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary())
