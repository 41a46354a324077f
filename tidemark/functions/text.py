"""Scalar text functions as column expressions; Arrow functions only where no built-in exists."""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Function words by language, ligatures, leading articles, sentence closers.
FUNCTION_WORDS = {
    "es": ["de", "la", "que", "el", "en", "los", "del", "las", "por", "para", "con", "una", "es"],
    "en": ["the", "of", "and", "to", "in", "for", "is", "that", "with", "on", "as", "by", "are"],
    "pt": ["de", "da", "do", "que", "em", "para", "com", "uma", "os", "as", "no", "na", "não"],
}
PORTUGUESE_ONLY = ["não", "são", "está", "dos"]
SPANISH_ONLY = ["y", "el", "su", "ha"]
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl"}
ARTICLES = ["el", "la", "los", "las", "un", "una", "unos", "unas", "the", "a", "an", "o", "os", "as", "um", "uma", "uns", "umas"]
CLOSERS = '.!?:…”"»)'


def strip(text: Column) -> Column:
    """Without white space at both ends, of any kind."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


#: Abbreviations after which a sentence goes on, by language; single capitals count as initials in all of them.
ABBREVIATIONS = {
    "es": ["art", "arts", "aprox", "av", "cap", "cía", "dr", "dra", "ej", "etc", "fig", "gral", "ing", "lic", "máx", "mín", "núm", "nro", "pág", "págs", "párr", "prof", "ref", "sr", "sra", "srta", "ud", "uds", "vol"],
    "en": ["approx", "art", "ca", "capt", "cf", "col", "dept", "dr", "e.g", "etc", "fig", "gen", "i.e", "inc", "lt", "ltd", "mr", "mrs", "ms", "no", "nos", "pp", "prof", "rev", "sec", "sen", "sgt", "st", "vol", "vs"],
    "pt": ["art", "arts", "aprox", "av", "cap", "cia", "dr", "dra", "eng", "etc", "ex", "fig", "máx", "mín", "núm", "pág", "págs", "prof", "ref", "sr", "sra", "srta", "vol"],
}
_JOINED = "\ue000"


def sentences(text: Column, lang: Column | None = None) -> Column:
    """Split after a closer and white space, and at line ends; stripped, without empty ones.

    With a language (es, en, pt; others as en) a full stop after one of its abbreviations or an initial doesn't split.
    """
    if lang is not None:
        known = lambda k: r"(?i:" + "|".join(re.escape(x) for x in ABBREVIATIONS[k]) + r")|\p{Lu}"
        join = lambda k: F.regexp_replace(text, r"(?<![\p{L}\p{N}])((?:" + known(k) + r")\.)[ \t]+(?=\S)", "$1" + _JOINED)
        text = F.when(lang == "es", join("es")).when(lang == "pt", join("pt")).otherwise(join("en"))
    parts = F.transform(F.split(text, r"(?<=[.!?…])\s+(?=\S)|\n+"), lambda s: strip(s if lang is None else F.translate(s, _JOINED, " ")))
    return F.filter(parts, lambda s: s != "")


def truncate_words(text: Column, most: int) -> Column:
    """Leading sentences while they fit; if the first alone is too long, its first words."""
    empty = F.struct(F.lit("").alias("s"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("full"))

    def add(state: Column, s: Column) -> Column:
        n = word_count(s)
        first = (state["n"] == 0) & ~state["full"]
        fits = ~state["full"] & (state["n"] + n <= most)
        cut = F.array_join(F.slice(words(s), 1, most), " ")
        return F.struct(
            F.when(first & (n > most), cut).when(fits & first, s).when(fits, F.concat(state["s"], F.lit(" "), s)).otherwise(state["s"]).alias("s"),
            F.when(first & (n > most), F.lit(most).cast("long")).when(fits, state["n"] + n).otherwise(state["n"]).alias("n"),
            (~fits).alias("full"),
        )

    return F.aggregate(sentences(text), empty, add, lambda st: st["s"])


#: Bytes of text that a task holds as Python objects at once, besides the first text of a slice.
SLICE = 1 << 20


def slices(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Runs of rows of about SLICE bytes each."""
    ends = np.cumsum(sizes)
    cuts = np.flatnonzero(np.diff(ends // SLICE)) + 1 if len(sizes) else []
    return list(zip([0, *cuts], [*cuts, len(sizes)]))


def list_slices(lists: pa.Array):
    """An Arrow array of lists of texts, in slices."""
    bytes_upto = np.r_[0, np.cumsum(pc.fill_null(pc.binary_length(lists.values), 0).to_numpy(zero_copy_only=False))]
    for lo, hi in slices(np.diff(bytes_upto[lists.offsets.to_numpy()])):
        yield lists[lo:hi]


def each_text(f):
    """An Arrow function of texts from a function of one text. A batch is thousands of texts of any length, so it is
    turned into Python texts in slices."""

    @F.arrow_udf(T.StringType())
    def run(texts: pa.Array) -> pa.Array:
        if texts.null_count == len(texts):
            return pa.nulls(len(texts), pa.string())
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        made = [pa.array([None if t is None else f(t) for t in texts[lo:hi].to_pylist()], pa.string()) for lo, hi in slices(sizes)]
        return pa.concat_arrays(made)

    return run


def _fold(text: str) -> str:
    return text if text.isascii() else "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


_nfc, _without_marks = each_text(lambda t: unicodedata.normalize("NFC", t)), each_text(_fold)
#: Blocks of the scripts that column functions treat themselves: Latin, Greek, Cyrillic, marks, punctuation, kana, Han.
_BLOCKS = [(0, 0x24F), (0x300, 0x52F), (0x1E00, 0x1FFF), (0x2010, 0x2027), (0x20A0, 0x20C0), (0x3001, 0x30FF), (0x4E00, 0x9FFF)]


def _class(safe) -> str:
    """A pattern for any character of _BLOCKS that isn't safe, and for any outside of them."""
    points = [c for lo, hi in _BLOCKS for c in range(lo, hi + 1) if safe(chr(c))]
    heads = [c for k, c in enumerate(points) if not k or points[k - 1] != c - 1]
    tails = [c for k, c in enumerate(points) if k + 1 == len(points) or points[k + 1] != c + 1]
    # the first class is one quick range, the second one many
    return r"[^\x00-\x7f](?<=[^" + "".join(rf"\x{{{lo:x}}}-\x{{{hi:x}}}" for lo, hi in zip(heads, tails)) + "])"


@cache
def _folding() -> tuple[str, str, str]:
    """The pattern of characters that Python folds (to several, or outside the blocks), and the others with their folded
    ones; those that fold to nothing come last. Each character folds by itself, whatever stands around it."""
    known = [chr(c) for lo, hi in _BLOCKS for c in range(lo, hi + 1)]
    one = {c: _fold(c) for c in known if len(_fold(c)) == 1 and _fold(c) != c}
    none = "".join(c for c in known if not _fold(c))
    return _class(lambda c: len(_fold(c)) < 2), "".join(one) + none, "".join(one.values())


@cache
def _composing() -> str:
    """The pattern of characters that NFC may change or join with the one before."""
    stays = lambda c: unicodedata.is_normalized("NFC", c) and not unicodedata.combining(c) and unicodedata.normalize("NFC", "a" + c) == "a" + c
    return _class(lambda c: stays(c))


def nfc(text: Column) -> Column:
    """Canonical composition. Only texts that may change go to Python."""
    hard = text.rlike(_composing())
    return F.when(hard, _nfc(F.when(hard, text))).otherwise(text)


def without_marks(text: Column) -> Column:
    """Compatibility decomposition without combining marks. Only texts with rarer characters go to Python."""
    hard, old, new = _folding()
    plain = ~text.rlike(r"[^\x00-\x7f]")
    return F.when(plain, text).when(text.rlike(hard), _without_marks(F.when(text.rlike(hard), text))).otherwise(F.translate(text, old, new))


def collapse_newlines(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def normalise(text: Column) -> Column:
    """Ligatures, NFC, control characters, line ends, runs of spaces, spaces at line ends, runs of empty lines."""
    t = text
    for old, new in LIGATURES.items():
        t = F.replace(t, F.lit(old), F.lit(new))
    t = nfc(t)
    t = F.regexp_replace(t, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " ")
    t = F.regexp_replace(t, r"\r\n?", "\n")
    t = F.regexp_replace(t, r"[ \t\u00a0\u2000-\u200a]+", " ")
    t = F.array_join(F.transform(F.split(t, "\n", -1), strip), "\n")
    return collapse_newlines(t)


def boilerplate(docs: DataFrame, id_col: str, text_col: str, repeats: int = 4, longest: int = 90) -> DataFrame:
    """(id, line): stripped lines of at most so many characters that a text of at least 2 * repeats lines repeats."""
    lines = F.split(text_col, "\n", -1)
    rows = docs.filter(F.size(lines) >= 2 * repeats).select(id_col, F.explode(F.transform(lines, strip)).alias("line"))
    rows = rows.filter((F.col("line") != "") & (F.length("line") <= longest))
    return rows.groupBy(id_col, "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= repeats)


def drop_boilerplate(docs: DataFrame, id_col: str, text_col: str, bad: DataFrame) -> DataFrame:
    """Texts without their boilerplate lines."""
    lists = bad.groupBy(id_col).agg(F.collect_set("line").alias("_bad"))
    stays = F.filter(F.split(text_col, "\n", -1), lambda x: ~F.array_contains("_bad", strip(x)))
    text = F.when(F.col("_bad").isNull(), F.col(text_col)).otherwise(F.array_join(stays, "\n"))
    return docs.join(lists, id_col, "left").withColumn(text_col, collapse_newlines(text)).drop("_bad")


def drop_numbering(text: Column) -> Column:
    """Without lines of up to 12 white space, digits and marks only; empty lines stay."""
    stays = F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(r"(?U)^[\s\d\W]{0,12}$") | (strip(x) == ""))
    return F.array_join(stays, "\n")


def language(text: Column) -> Column:
    """es, en, pt or xx by counts of function words in the first 20 000 characters."""
    found = F.regexp_extract_all(F.lower(F.substring(text, 1, 20000)), F.lit(r"(?U)\w+"), 0)
    hits = lambda names: F.size(F.filter(found, lambda w: w.isin(names)))
    es, en, pt = (hits(FUNCTION_WORDS[k]) for k in ("es", "en", "pt"))
    best = F.greatest(es, en, pt)
    iberian = F.when(hits(PORTUGUESE_ONLY) > hits(SPANISH_ONLY), "pt").otherwise("es")
    return F.when((F.size(found) < 20) | (best == 0), "xx").when(es == best, iberian).when(en == best, "en").otherwise(iberian)


def clean(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Normalised texts without boilerplate and numbering, and their language."""
    out = docs.withColumn(text_col, normalise(F.col(text_col)))
    out = drop_boilerplate(out, id_col, text_col, boilerplate(out, id_col, text_col))
    out = out.withColumn(text_col, collapse_newlines(drop_numbering(F.col(text_col))))
    return out.withColumn("idioma", language(F.col(text_col)))


def match_key(text: Column, fold: bool = True) -> Column:
    """Lower case without marks (if fold), other characters as spaces, spaces collapsed."""
    low = F.lower(text)
    low = without_marks(low) if fold else low
    return F.trim(F.regexp_replace(F.regexp_replace(low, r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def name_key(name: Column) -> Column:
    """match_key without one leading article, if more follows."""
    key = match_key(name)
    return F.when(key.contains(" "), F.regexp_replace(key, "^(" + "|".join(ARTICLES) + ") ", "")).otherwise(key)


def admissible(name: Column) -> Column:
    t = strip(name)
    return (F.length(t) >= 2) & (word_count(t) <= 8) & t.rlike(r"\p{L}")


def evidence(text: Column, most: int = 240) -> Column:
    t = strip(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.when(F.length(t) > most, F.concat(F.rtrim(F.left(t, F.lit(most - 1))), F.lit("…"))).otherwise(t)


def diacritics(text: Column) -> Column:
    """Accented among all letters; 0 without letters."""
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    return F.coalesce(F.try_divide(F.regexp_count(F.lower(text), F.lit("[áéíóúñü]")), letters), F.lit(0.0))


def unprintable(text: Column) -> Column:
    """Share of control, private and unassigned characters other than line end and tab."""
    return F.coalesce(F.try_divide(F.regexp_count(text, F.lit(r"[\p{Cc}\p{Co}\p{Cn}&&[^\n\t]]")), F.length(text)), F.lit(0.0))


def ocr_signals(text: Column, pages: Column, seconds: Column) -> Column:
    n = word_count(text)
    return F.struct(
        pages.alias("paginas"), n.alias("palabras"), F.round(F.coalesce(F.try_divide(n, pages), F.lit(0.0)), 1).alias("palabras_pagina"),
        language(text).alias("idioma"), F.round(diacritics(text), 4).alias("diacriticos"), F.round(unprintable(text), 5).alias("no_imprimible"), seconds.alias("segundos"),
    )


def ocr_suspicions(s: Column) -> Column:
    flags = [
        F.when((s["idioma"] == "es") & (s["diacriticos"] < 0.005), "sin diacriticos"),
        F.when(s["no_imprimible"] > 0.01, "no imprimible"),
        F.when(s["palabras_pagina"] < 20, "pocas palabras"),
    ]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def closes_sentence(text: Column) -> Column:
    return text.rlike(r'[.!?:…”"»)]\s*$')


def phenomenon_of(query_id: Column) -> Column:
    """1 to 16, 17 to 32 and 33 to 50 of the number in an id such as q017; null for others."""
    n = F.regexp_replace(query_id, "^q+", "").try_cast("int")
    return F.when(n.between(1, 16), 1).when(n.between(17, 32), 2).when(n.between(33, 50), 3)


def chunking_key(tokens: Column, overlap: Column) -> Column:
    return F.format_string("c%d-s%03d", tokens, F.rint(overlap * 100).cast("int"))


def fits_window(tokens: Column, window: Column, margin: int = 8) -> Column:
    return tokens + margin <= window


def row_text(columns: list[str]) -> Column:
    """`column: value` of the cells that aren't blank, joined by ` | `."""
    cell = lambda c: F.when(F.trim(F.col(c).cast("string")) != "", F.concat(F.lit(f"{c}: "), F.trim(F.col(c).cast("string"))))
    return F.concat_ws(" | ", *[cell(c) for c in columns])


def clean_section(text: Column, bad: Column) -> Column:
    """A section's text normalised, without the given boilerplate lines of its document, and without numbering."""
    lines = F.filter(F.split(normalise(text), "\n", -1), lambda x: ~F.array_contains(bad, strip(x)))
    return collapse_newlines(drop_numbering(F.array_join(lines, "\n")))
