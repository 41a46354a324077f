"""Queries of text functions, chunking, matching, graph, sampling, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import chunking, graph, matching, sampling
from tidemark.plans.registry import BASE, Tables, query, sentence_list
from tidemark.sources import readers, sinks

# text

_LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)"
_BAD = f"{_LINES}, big AS (SELECT doc_id FROM lines GROUP BY 1 HAVING count(*) >= 8), bad AS (SELECT doc_id, trim(raw) AS line, count(*) AS n FROM lines SEMI JOIN big USING (doc_id) WHERE trim(raw) <> '' AND length(trim(raw)) <= 90 GROUP BY 1, 2 HAVING count(*) >= 4)"


def _docs(t: Tables):
    return t.documents.select("doc_id", F.col("text").alias("texto"))


@query("txt_01_normalise", r"""
WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(nfc_normalize(text), '\r\n?', chr(10), 'g'), '[ \t\x{00A0}\x{2000}-\x{200A}]+', ' ', 'g') AS t FROM documents),
l AS (SELECT doc_id, list_transform(string_split(t, chr(10)), lambda x: trim(x)) AS ls FROM a)
SELECT doc_id, trim(regexp_replace(array_to_string(ls, chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9)) AS texto FROM l""")
def _(t: Tables):
    return _docs(t).withColumn("texto", T.normalise(F.col("texto")))


@query("txt_02_boilerplate", f"WITH {_BAD} SELECT doc_id, line, n FROM bad")
def _(t: Tables):
    return T.boilerplate(_docs(t), "doc_id", "texto")


@query("txt_03_drop_boilerplate", f"""WITH {_BAD}, kept AS (SELECT l.doc_id, l.i, l.raw FROM lines l ANTI JOIN bad b ON b.doc_id = l.doc_id AND b.line = trim(l.raw))
SELECT d.doc_id, trim(regexp_replace(coalesce(k.t, ''), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9)) AS texto FROM documents d LEFT JOIN (SELECT doc_id, string_agg(raw, chr(10) ORDER BY i) AS t FROM kept GROUP BY 1) k USING (doc_id)""")
def _(t: Tables):
    docs = _docs(t)
    return T.drop_boilerplate(docs, "doc_id", "texto", T.boilerplate(docs, "doc_id", "texto"))


@query("txt_04_drop_numbering", f"""WITH {_LINES}, kept AS (SELECT * FROM lines WHERE NOT regexp_full_match(raw, '[^\\p{{L}}_]{{0,12}}') OR trim(raw) = '')
SELECT d.doc_id, coalesce(string_agg(raw, chr(10) ORDER BY i), '') AS texto FROM documents d LEFT JOIN kept USING (doc_id) GROUP BY 1""")
def _(t: Tables):
    return _docs(t).withColumn("texto", T.drop_numbering(F.col("texto")))


def _has(words: list[str]) -> str:
    return "len(list_filter(w, lambda x: x IN (" + ", ".join(f"'{x}'" for x in words) + ")))"


def _language_sql(source: str, text: str) -> str:
    """CTEs that end in idioma (doc_id, idioma)."""
    return f"""x AS (SELECT doc_id, regexp_extract_all(lower(substr({text}, 1, 20000)), '[\\p{{L}}\\p{{N}}_]+') AS w FROM {source}),
c AS (SELECT doc_id, len(w) AS n, {_has(T.FUNCTION_WORDS['es'])} AS es, {_has(T.FUNCTION_WORDS['en'])} AS en, {_has(T.FUNCTION_WORDS['pt'])} AS pt,
  CASE WHEN {_has(T.PORTUGUESE_ONLY)} > {_has(T.SPANISH_ONLY)} THEN 'pt' ELSE 'es' END AS ib FROM x),
idioma AS (SELECT doc_id, CASE WHEN n < 20 OR greatest(es, en, pt) = 0 THEN 'xx' WHEN es = greatest(es, en, pt) THEN ib WHEN en = greatest(es, en, pt) THEN 'en' ELSE ib END AS idioma FROM c)"""


@query("txt_05_language", "WITH " + _language_sql("documents", "text") + " SELECT doc_id, idioma FROM idioma")
def _(t: Tables):
    return _docs(t).select("doc_id", T.language(F.col("texto")).alias("idioma"))


_NORMAL = r"""a AS (SELECT doc_id, regexp_replace(regexp_replace(nfc_normalize(text), '\r\n?', chr(10), 'g'), '[ \t\x{00A0}\x{2000}-\x{200A}]+', ' ', 'g') AS t FROM documents),
l AS (SELECT doc_id, list_transform(string_split(t, chr(10)), lambda x: trim(x)) AS ls FROM a),
normal AS (SELECT doc_id, trim(regexp_replace(array_to_string(ls, chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9)) AS text FROM l)"""
_TIDY = "trim(regexp_replace(coalesce({0}, ''), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9))"


@query("txt_06_clean", f"""WITH {_NORMAL}, {_BAD.replace("FROM documents", "FROM normal")},
first AS (SELECT l.doc_id, string_agg(l.raw, chr(10) ORDER BY l.i) AS t FROM lines l ANTI JOIN bad b ON b.doc_id = l.doc_id AND b.line = trim(l.raw) GROUP BY 1),
tidy AS (SELECT doc_id, {_TIDY.format('t')} AS t FROM normal LEFT JOIN first USING (doc_id)),
rows AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS raw, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM tidy),
second AS (SELECT doc_id, string_agg(raw, chr(10) ORDER BY i) AS t FROM rows WHERE NOT regexp_full_match(raw, '[^\\p{{L}}_]{{0,12}}') OR trim(raw) = '' GROUP BY 1),
done AS (SELECT doc_id, {_TIDY.format('s.t')} AS texto FROM tidy LEFT JOIN second s USING (doc_id)), {_language_sql('done', 'texto')}
SELECT doc_id, texto, idioma FROM done JOIN idioma USING (doc_id)""")
def _(t: Tables):
    return T.clean(_docs(t), "doc_id", "texto")


@query("txt_08_word_count", "SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))::BIGINT AS palabras FROM documents")
def _(t: Tables):
    return _docs(t).select("doc_id", T.word_count(F.col("texto")).alias("palabras"))


_FOLD = "trim(regexp_replace(regexp_replace(strip_accents(lower({0})), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


@query("txt_09_match_key", f"SELECT doc_id, md5({_FOLD.format('text')}) AS clave FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", F.md5(T.match_key(F.col("text"))).alias("clave"))


_ARTICLES = "|".join(T.ARTICLES)


@query("txt_10_name_key", f"WITH k AS (SELECT doc_id, {_FOLD.format('text')} AS k FROM documents) SELECT doc_id, md5(CASE WHEN contains(k, ' ') THEN regexp_replace(k, '^({_ARTICLES}) ', '') ELSE k END) AS clave FROM k")
def _(t: Tables):
    return t.documents.select("doc_id", F.md5(T.name_key(F.col("text"))).alias("clave"))


@query("txt_11_admissible", "SELECT conv_id, turn, length(trim(text)) >= 2 AND len(regexp_split_to_array(trim(text), '\\s+')) <= 8 AND regexp_matches(text, '\\p{L}') AS admisible FROM conversations")
def _(t: Tables):
    return t.conversations.select("conv_id", "turn", T.admissible(F.col("text")).alias("admisible"))


@query("txt_12_evidence", "WITH x AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS s FROM documents) SELECT doc_id, CASE WHEN length(s) > 240 THEN rtrim(left(s, 239)) || '…' ELSE s END AS evidencia FROM x")
def _(t: Tables):
    return t.documents.select("doc_id", T.evidence(F.col("text")).alias("evidencia"))


@query("txt_13_diacritics", "SELECT doc_id, round(coalesce(len(regexp_extract_all(lower(text), '[áéíóúñü]')) / nullif(len(regexp_extract_all(text, '\\p{L}')), 0)::DOUBLE, 0), 6) AS densidad FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", F.round(T.diacritics(F.col("text")), 6).alias("densidad"))


@query("txt_14_unprintable", "SELECT doc_id, round(len(regexp_extract_all(text, '[\\x00-\\x08\\x0B-\\x1F\\x7F-\\x{9F}]')) / length(text)::DOUBLE, 6) AS ratio FROM documents WHERE length(text) > 0")
def _(t: Tables):
    return t.documents.filter(F.length("text") > 0).select("doc_id", F.round(T.unprintable(F.col("text")), 6).alias("ratio"))


_SIGNALS = "WITH " + _language_sql("documents", "text") + r"""
, s AS (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::BIGINT AS palabras, greatest(1, n_chars // 1800) AS paginas,
  round(coalesce(len(regexp_extract_all(lower(text), '[áéíóúñü]')) / nullif(len(regexp_extract_all(text, '\p{L}')), 0)::DOUBLE, 0), 4) AS diacriticos,
  round(coalesce(len(regexp_extract_all(text, '[\x00-\x08\x0B-\x1F\x7F-\x{9F}]')) / nullif(length(text), 0)::DOUBLE, 0), 5) AS raros FROM documents),
r AS (SELECT *, round(palabras / paginas::DOUBLE, 1) AS palabras_pagina FROM s JOIN idioma USING (doc_id))
"""


def _signals(t: Tables):
    s = T.ocr_signals(F.col("text"), F.greatest(F.lit(1), F.floor(F.col("n_chars") / 1800)), F.lit(1.0))
    return t.documents.select("doc_id", s.alias("s"))


@query("txt_15_ocr_signals", _SIGNALS + "SELECT doc_id, paginas, palabras, palabras_pagina, idioma, diacriticos, raros FROM r")
def _(t: Tables):
    return _signals(t).select("doc_id", "s.paginas", "s.palabras", "s.palabras_pagina", "s.idioma", "s.diacriticos", F.col("s.no_imprimible").alias("raros"))


@query("txt_16_ocr_suspicions", _SIGNALS + """SELECT doc_id, palabras, palabras_pagina, idioma, diacriticos, array_to_string(list_filter([CASE WHEN idioma = 'es' AND diacriticos < 0.005 THEN 'sin diacriticos' END,
  CASE WHEN raros > 0.01 THEN 'no imprimible' END, CASE WHEN palabras_pagina < 20 THEN 'pocas palabras' END], lambda x: x IS NOT NULL), ',') AS avisos FROM r""")
def _(t: Tables):
    return _signals(t).select("doc_id", "s.palabras", "s.palabras_pagina", "s.idioma", "s.diacriticos", F.array_join(T.ocr_suspicions(F.col("s")), ",").alias("avisos"))


@query("txt_17_phenomenon", "SELECT o_orderkey, CASE WHEN o_orderkey BETWEEN 1 AND 16 THEN 1 WHEN o_orderkey BETWEEN 17 AND 32 THEN 2 WHEN o_orderkey BETWEEN 33 AND 50 THEN 3 END::BIGINT AS fenomeno FROM orders")
def _(t: Tables):
    return t.orders.select("o_orderkey", T.phenomenon_of(F.format_string("q%03d", "o_orderkey")).alias("fenomeno"))


@query("txt_18_chunking_key", "SELECT p_partkey, printf('c%d-s%03d', p_size, (p_partkey % 30)::BIGINT) AS clave FROM part")
def _(t: Tables):
    return t.part.select("p_partkey", T.chunking_key(F.col("p_size"), (F.col("p_partkey") % 30) / 100).alias("clave"))


@query("txt_19_fits_window", "SELECT p_partkey, p_size + 8 <= 32 AS cabe FROM part")
def _(t: Tables):
    return t.part.select("p_partkey", T.fits_window(F.col("p_size"), F.lit(32)).alias("cabe"))


# chunking


@query("chk_01_sentences", f"SELECT doc_id, len(s)::BIGINT AS n, md5(array_to_string(s, chr(10))) AS oraciones FROM (SELECT doc_id, {sentence_list('text')} AS s FROM documents)")
def _(t: Tables):
    rows = t.documents.select("doc_id", T.sentences(F.col("text")).alias("s"))
    return rows.select("doc_id", F.size("s").alias("n"), F.md5(F.array_join("s", "\n")).alias("oraciones"))


@query("chk_03_pack", """
WITH RECURSIVE u AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k, s, len(list_filter(regexp_split_to_array(s, '\\s+'), lambda w: w <> ''))::BIGINT AS n FROM (
    SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE s <> ''
), f AS (
  SELECT doc_id, k, n, n AS total, 0::BIGINT AS c FROM u WHERE k = 1
  UNION ALL
  SELECT u.doc_id, u.k, u.n, CASE WHEN f.total + u.n > 100 THEN u.n ELSE f.total + u.n END, CASE WHEN f.total + u.n > 100 THEN f.c + 1 ELSE f.c END FROM f JOIN u ON u.doc_id = f.doc_id AND u.k = f.k + 1
)
SELECT f.doc_id, f.c AS posicion, sum(f.n)::BIGINT AS tokens, string_agg(u.s, ' ' ORDER BY f.k) AS texto FROM f JOIN u USING (doc_id, k) GROUP BY 1, 2""")
def _(t: Tables):
    units = F.filter(F.transform(F.split("text", "\n"), T.strip), lambda s: s != "")
    rows = t.documents.select("doc_id", F.posexplode(chunking.pack(units, 100, 0.0, long_units=False)).alias("posicion", "c"))
    return rows.select("doc_id", "posicion", "c.tokens", "c.texto")


@query("chk_03_pack_overlap")
def _(t: Tables):
    rows = t.documents.select("doc_id", F.posexplode(chunking.pack(T.sentences(F.col("text")), 100, 0.15)).alias("posicion", "c"))
    return rows.select("doc_id", "posicion", "c.tokens", "c.texto")


@query("chk_04_recheck", """
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '') AS w FROM documents), s AS (SELECT doc_id, w, unnest(range(0, len(w), 498)) AS i FROM w WHERE len(w) > 500)
SELECT doc_id, i // 498 AS parte, len(w[i + 1:i + 498])::BIGINT AS num_tokens FROM s UNION ALL SELECT doc_id, 0, len(w)::BIGINT FROM w WHERE len(w) <= 500""")
def _(t: Tables):
    rows = t.documents.select("doc_id", F.lit(0).alias("posicion"), F.col("text").alias("texto")).withColumn("num_tokens", T.word_count(F.col("texto")))
    return chunking.over_budget(rows, 500).select("doc_id", "parte", "num_tokens")


@query("chk_06_windows", "WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '') AS w FROM documents), s AS (SELECT doc_id, w, unnest(range(0, len(w), 62)) AS i FROM w) SELECT doc_id, i // 62 AS parte, array_to_string(w[i + 1:i + 62], ' ') AS texto FROM s")
def _(t: Tables):
    return t.documents.select("doc_id", F.posexplode(chunking.windows(F.col("text"), 64)).alias("parte", "texto"))


@query("chk_07_tabular_cut", "SELECT doc_id, CASE WHEN length(t) <= 1200 THEN t WHEN instr(left(t, 1200), chr(10) || chr(10)) = 0 THEN left(t, 1200) ELSE left(left(t, 1200), 1200 - instr(reverse(left(t, 1200)), chr(10) || chr(10)) - 1) END AS texto FROM (SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS t FROM documents)")
def _(t: Tables):
    text = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    return t.documents.withColumn("t", text).select("doc_id", chunking.tabular_cut(F.col("t"), 20, 10).alias("texto"))


def _chunked(t: Tables):
    docs = t.documents.select("doc_id", F.when(F.pmod("doc_id", F.lit(5)) == 0, "csv").otherwise("txt").alias("formato"), F.col("text").alias("texto"))
    return chunking.chunk(docs, budget=120, tabular=4)


@query("chk_08_chunks")
def _(t: Tables):
    return _chunked(t)


@query("chk_08_coverage", "SELECT count(*) AS docs FROM (SELECT doc_id FROM documents WHERE len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) >= 10)")
def _(t: Tables):
    docs = t.documents.select("doc_id", F.lit("txt").alias("formato"), F.col("text").alias("texto"))
    out = chunking.chunk(docs, budget=100_000, overlap=0.0).select("doc_id").distinct()
    return out.agg(F.count(F.lit(1)).alias("docs"))


def _lines(t: Tables):
    """Line items as printed lines: an order is a document, a large quantity a large font."""
    li = t.lineitem
    size = F.when(F.col("l_quantity") > 40, 14.0).when(F.col("l_quantity") > 35, 12.0).otherwise(10.0)
    text = F.concat(F.lit("linea "), F.col("l_partkey"), F.when(F.col("l_returnflag") == "R", F.lit(".")).otherwise(F.lit("")))
    return li.select(F.col("l_orderkey").alias("doc_id"), (F.col("l_linenumber") * 10_000_000 + F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("linea"), text.alias("texto"), size.alias("tamano"), (F.col("l_linestatus") == "F").alias("negrita"))


_LINE_SQL = """
WITH lines AS (SELECT l_orderkey AS doc_id, l_linenumber * 10000000 + l_partkey * 1000 + l_suppkey AS linea, 'linea ' || l_partkey || CASE WHEN l_returnflag = 'R' THEN '.' ELSE '' END AS texto,
  CASE WHEN l_quantity > 40 THEN 14.0 WHEN l_quantity > 35 THEN 12.0 ELSE 10.0 END::DOUBLE AS tamano, l_linestatus = 'F' AS negrita FROM lineitem),
body AS (SELECT doc_id, arg_max(tamano, n * 1000 - tamano) AS cuerpo FROM (SELECT doc_id, tamano, sum(length(texto)) AS n FROM lines GROUP BY 1, 2) GROUP BY 1),
marked AS (SELECT l.*, cuerpo, length(texto) <= 140 AND NOT regexp_matches(texto, '[.;,]$') AND (tamano > 1.15 * cuerpo OR (negrita AND tamano >= cuerpo AND coalesce(regexp_matches(lag(texto) OVER w, '[.!?:…”"»)]\\s*$'), true))) AS h
  FROM lines l JOIN body USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY linea))
"""


@query("chk_13_body_size", _LINE_SQL + "SELECT doc_id, cuerpo FROM body")
def _(t: Tables):
    return chunking.headings(_lines(t)).select("doc_id", "cuerpo").distinct()


@query("chk_14_headings", _LINE_SQL + "SELECT doc_id, linea::BIGINT AS linea, h AS es_encabezado FROM marked")
def _(t: Tables):
    return chunking.headings(_lines(t)).select("doc_id", "linea", "es_encabezado")


@query("chk_15_sections", _LINE_SQL + """
, num AS (SELECT *, sum(h::INT) OVER (PARTITION BY doc_id ORDER BY linea ROWS UNBOUNDED PRECEDING)::BIGINT AS seccion FROM marked),
ok AS (SELECT doc_id FROM num GROUP BY 1 HAVING max(seccion) >= 2),
lev AS (SELECT doc_id, tamano, dense_rank() OVER (PARTITION BY doc_id ORDER BY tamano DESC) AS nivel FROM (SELECT DISTINCT doc_id, tamano FROM num WHERE h)),
sec AS (SELECT doc_id, seccion, max(CASE WHEN h THEN texto END) AS titulo, max(CASE WHEN h THEN tamano END) AS tamano, string_agg(texto, chr(10) ORDER BY linea) AS texto FROM num SEMI JOIN ok USING (doc_id) GROUP BY 1, 2)
SELECT s.doc_id, seccion, titulo, coalesce(nivel, 0) AS nivel, texto FROM sec s LEFT JOIN lev l ON l.doc_id = s.doc_id AND l.tamano = s.tamano""")
def _(t: Tables):
    return chunking.sections_of(_lines(t))


def _sections(t: Tables):
    one = F.struct(F.concat(F.lit("t"), F.col("turn")).alias("titulo"), F.col("text").alias("texto"))
    rows = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", one.alias("s")))).alias("_s"))
    return rows.select("conv_id", F.col("_s")["s"].alias("secciones"))


@query("chk_10_align_sections", f"""
WITH RECURSIVE s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, 't' || turn AS titulo, text FROM conversations),
f AS (
  SELECT conv_id, 0::BIGINT AS k, '' AS titulo, '' AS kept, '' AS carry FROM s WHERE k = 1
  UNION ALL
  SELECT conv_id, k, titulo, CASE WHEN o THEN array_to_string(ls[1:len(ls) - 1], ' ') ELSE t END, CASE WHEN o THEN ls[len(ls)] ELSE '' END
  FROM (SELECT *, len(ls) > 0 AND NOT regexp_matches(t, '[.!?:…”"»)]\\s*$') AS o FROM (
    SELECT conv_id, k, titulo, t, {sentence_list('t')} AS ls FROM (SELECT s.conv_id, s.k, s.titulo, trim(f.carry || ' ' || s.text) AS t FROM f JOIN s ON s.conv_id = f.conv_id AND s.k = f.k + 1)))
), whole AS (SELECT conv_id, k, titulo, CASE WHEN carry <> '' AND k = max(k) OVER (PARTITION BY conv_id) THEN trim(kept || ' ' || carry) ELSE kept END AS texto FROM f WHERE k > 0)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY k) - 1 AS n, titulo, texto FROM whole WHERE texto <> ''""")
def _(t: Tables):
    rows = _sections(t).select("conv_id", F.posexplode(chunking.align_sections(F.col("secciones"))).alias("n", "s"))
    return rows.select("conv_id", "n", "s.titulo", "s.texto")


@query("chk_11_merge_sections", """
WITH RECURSIVE s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))::BIGINT AS n FROM conversations),
f AS (SELECT conv_id, k, n AS total, 0::BIGINT AS g, n >= 60 AS shut FROM s WHERE k = 1
  UNION ALL SELECT s.conv_id, s.k, CASE WHEN f.shut THEN s.n ELSE f.total + s.n END, CASE WHEN f.shut THEN f.g + 1 ELSE f.g END, CASE WHEN f.shut THEN s.n ELSE f.total + s.n END >= 60 FROM f JOIN s ON s.conv_id = f.conv_id AND s.k = f.k + 1),
e AS (SELECT conv_id, g, max(total) AS tokens FROM f GROUP BY 1, 2), l AS (SELECT conv_id, max(g) AS last FROM e GROUP BY 1)
SELECT conv_id, CASE WHEN e.g = last AND e.g > 0 AND tokens < 60 THEN g - 1 ELSE g END AS n, sum(tokens)::BIGINT AS tokens FROM e JOIN l USING (conv_id) GROUP BY 1, 2""")
def _(t: Tables):
    rows = _sections(t).select("conv_id", F.posexplode(chunking.merge_sections(F.col("secciones"))).alias("n", "s"))
    return rows.select("conv_id", "n", "s.tokens")


@query("chk_17_closes_sentence", "SELECT conv_id, turn, regexp_matches(text, '[.!?:…”\"»)]\\s*$') AS cierra FROM conversations")
def _(t: Tables):
    return t.conversations.select("conv_id", "turn", T.closes_sentence(F.col("text")).alias("cierra"))


@query("chk_18_status", "SELECT CASE WHEN doc_id % 11 = 0 THEN 'error_extraccion' WHEN length(trim(text)) < 200 THEN 'pendiente_ocr' WHEN doc_id % 7 = 0 THEN 'sin_fragmentos' ELSE 'ok' END AS estado, count(*) AS n FROM documents GROUP BY 1")
def _(t: Tables):
    error = F.when(F.col("doc_id") % 11 == 0, "x")
    chunks = F.when(F.col("doc_id") % 7 == 0, 0).otherwise(1)
    rows = t.documents.select(chunking.status(error, readers.needs_ocr(F.col("text")), F.col("text"), F.col("text"), chunks).alias("estado"))
    return rows.groupBy("estado").agg(F.count(F.lit(1)).alias("n"))


# matching

_BAGS = """
WITH tok AS (SELECT 'd' AS k, doc_id AS id, list_filter(string_split({0}, ' '), lambda w: w <> '') AS t FROM documents UNION ALL SELECT 'b', item_id, list_filter(string_split({0}, ' '), lambda w: w <> '') FROM benchmark),
g AS (SELECT k, id, CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 5 THEN [array_to_string(t, ' ')] ELSE list_distinct(list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' '))) END AS g FROM tok)
""".format(_FOLD.format("text"))
_OVERLAPS = _BAGS + """
, x AS (SELECT id AS doc_id, len(g) AS n, unnest(g) AS gram FROM g WHERE k = 'd'), y AS (SELECT id AS item_id, len(g) AS m, unnest(g) AS gram FROM g WHERE k = 'b'),
o AS (SELECT doc_id, item_id, round(greatest(count(*) / any_value(n)::DOUBLE, count(*) / any_value(m)::DOUBLE), 6) AS overlap FROM x JOIN y USING (gram) GROUP BY 1, 2)
"""


@query("mat_01_grams", _BAGS + "SELECT id AS doc_id, len(g)::BIGINT AS n FROM g WHERE k = 'd' AND len(g) > 0")
def _(t: Tables):
    bags = matching.bags(t.documents, "doc_id", "text")
    return bags.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


def _overlaps(t: Tables):
    a, b = matching.hashed(t.documents, F.col("doc_id"), "text"), matching.hashed(t.benchmark, F.col("item_id"), "text")
    return matching.pairs_of(*matching.matches(a, b, 0.1, (t.documents.count(), t.benchmark.count())), "doc_id", "item_id")


@query("mat_02_overlap", _OVERLAPS + "SELECT doc_id, item_id, overlap FROM o WHERE overlap >= 0.1")
def _(t: Tables):
    return _overlaps(t)


@query("mat_03_grades", _OVERLAPS + "SELECT d.doc_id, coalesce(max(1 + o.item_id % 2), 0)::DOUBLE AS grade FROM documents d LEFT JOIN o ON o.doc_id = d.doc_id AND o.overlap >= 0.55 GROUP BY 1")
def _(t: Tables):
    texts = t.documents.select(F.lit(1).alias("query_id"), "doc_id", F.col("text").alias("texto"))
    judged = t.benchmark.select(F.lit(1).alias("query_id"), F.col("item_id").alias("judged_id"), (1.0 + F.col("item_id") % 2).alias("grade"), F.col("text").alias("texto"))
    return matching.grades(texts, judged, "doc_id").select("doc_id", "grade")


# graph


def _texts(t: Tables):
    return t.documents.select(F.col("doc_id").alias("chunk_id"), F.floor(F.col("doc_id") / 3).alias("doc_id"), F.col("text").alias("texto"))


@query("gra_01_windows", "WITH s AS (SELECT doc_id AS chunk_id, text, unnest(range(0, greatest(length(text), 1), 1000)) AS desde FROM documents) SELECT chunk_id, desde, least(desde + 1200, length(text)) AS hasta FROM s WHERE (desde = 0 OR desde + 200 < length(text)) AND trim(substr(text, desde + 1, 1200), ' ' || chr(10)) <> ''")
def _(t: Tables):
    return graph.windows(_texts(t)).select("chunk_id", "desde", "hasta")


@query("gra_02_locate", "SELECT conv_id, turn, CASE WHEN instr(text, 'the') > 0 THEN instr(text, 'the') - 1 END AS inicio FROM conversations")
def _(t: Tables):
    at = graph.locate(F.col("text"), F.lit("the"), F.lit(0), F.lit(3))
    return t.conversations.select("conv_id", "turn", at["inicio"].alias("inicio"))


@query("gra_07_mentions")
def _(t: Tables):
    return graph.mentions(_texts(t))


def _mentions(t: Tables):
    """Line items as mentions: an order is a chunk, four orders a document, a part a name in one of two spellings. First
    lines name ten parts that are found in too many documents."""
    part = F.when(F.col("l_linenumber") == 1, F.col("l_partkey") % 10).otherwise(F.col("l_partkey"))
    name = F.concat(F.when(F.col("l_linenumber") % 3 == 0, "the Part ").otherwise("Part "), part)
    return t.lineitem.select(
        F.col("l_orderkey").alias("chunk_id"), F.floor(F.col("l_orderkey") / 4).alias("doc_id"), name.alias("texto"), F.lit("organizacion").alias("tipo"),
        (F.col("l_linenumber") * 20).alias("inicio"), (F.col("l_linenumber") * 20 + 8).alias("fin"), F.lit(1.0).alias("confianza"),
    )


_MENTIONS = """
WITH m AS (SELECT l_orderkey AS chunk_id, l_orderkey // 4 AS doc_id, CASE WHEN l_linenumber % 3 = 0 THEN 'the Part ' ELSE 'Part ' END || k AS texto, 'part ' || k AS id, l_linenumber FROM (
  SELECT *, CASE WHEN l_linenumber = 1 THEN l_partkey % 10 ELSE l_partkey END AS k FROM lineitem)),
form AS (SELECT id, texto, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, texto) AS r FROM m GROUP BY id, texto),
ent AS (SELECT id, count(DISTINCT doc_id) AS df, string_agg(DISTINCT texto, '|' ORDER BY texto) AS alias FROM m GROUP BY 1),
adm AS (SELECT id FROM ent WHERE df BETWEEN 2 AND greatest(2, floor((SELECT count(DISTINCT doc_id) FROM m) * 0.05))),
cnt AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY n DESC, id) AS r FROM (SELECT chunk_id, doc_id, id, count(*) AS n FROM m SEMI JOIN adm USING (id) GROUP BY 1, 2, 3)),
top AS (SELECT * FROM cnt WHERE r <= 2),
rel AS (SELECT DISTINCT 'part ' || p_partkey AS s, 'part ' || (p_size * 7 % 300) AS o FROM part WHERE p_partkey <> p_size * 7 % 300),
rela AS (SELECT * FROM rel SEMI JOIN adm a ON a.id = rel.s SEMI JOIN adm b ON b.id = rel.o)
"""


def _documents(t: Tables) -> int:
    return _mentions(t).select("doc_id").distinct().count()


def _graph(t: Tables):
    found = _mentions(t)
    entities, ids = graph.canonical(found)
    good = graph.admitted(entities, _documents(t))
    pair = t.part.filter("p_partkey <> p_size * 7 % 300")
    rel = pair.select(F.concat(F.lit("part "), F.col("p_partkey")).alias("sujeto"), F.concat(F.lit("part "), F.col("p_size") * 7 % 300).alias("objeto")).distinct()
    rel = rel.select(F.lit(1).alias("chunk_id"), "sujeto", F.lit("opera").alias("tipo"), "objeto")
    return good, *graph.build(found, good, ids, rel, per_chunk=2)


@query("gra_09_canonical", _MENTIONS + "SELECT e.id, f.texto AS nombre, e.df, e.alias FROM ent e JOIN form f ON f.id = e.id AND f.r = 1")
def _(t: Tables):
    entities, _ = graph.canonical(_mentions(t))
    return entities.select("id", "nombre", "df", F.array_join("alias", "|").alias("alias"))


@query("gra_10_merge_similar", """
WITH RECURSIVE e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id AND list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.4),
r AS (SELECT a AS x, a AS y FROM e UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y)
SELECT x AS clave, min(y) AS id FROM r GROUP BY 1""")
def _(t: Tables):
    return graph.merge_alike(t.indices()["a"], 0.4)


@query("gra_11_admitted", _MENTIONS + "SELECT id FROM adm")
def _(t: Tables):
    return graph.admitted(graph.canonical(_mentions(t))[0], _documents(t)).select("id")


@query("gra_13_relation", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'regula' WHEN 1 THEN 'financia' WHEN 2 THEN 'miembro_de' END AS tipo, CASE c_custkey % 4 WHEN 0 THEN true WHEN 3 THEN NULL ELSE false END AS pasiva FROM customer")
def _(t: Tables):
    k = F.col("c_custkey") % 4
    gap = F.when(k == 0, " was regulated by ").when(k == 1, " finances the ").when(k == 2, " es miembro de la ").otherwise(" and ")
    return t.customer.select("c_custkey", graph.relation_of(gap).alias("r")).select("c_custkey", "r.tipo", "r.pasiva")


def _said(t: Tables):
    """Two sentences of each customer, the first with two names and what lies between them."""
    verbs = F.element_at(F.array(*[F.lit(v) for v in ("opera", "regulates", "funded by", "con")]), (F.col("c_custkey") % 4 + 1).cast("int"))
    text = F.concat(F.lit("Norte "), F.col("c_nationkey"), F.lit(" "), verbs, F.lit(" Sur. Otra Cosa "), F.col("c_custkey"), F.lit("."))
    return t.customer.select(F.col("c_custkey").alias("chunk_id"), F.col("c_nationkey").cast("long").alias("doc_id"), text.alias("texto"))


_SAID = """
WITH v AS (SELECT c_custkey AS chunk_id, c_nationkey::BIGINT AS doc_id, c_custkey % 4 AS k, 'Norte ' || c_nationkey || ' ' || ['opera', 'regulates', 'funded by', 'con'][1 + c_custkey % 4] || ' Sur.' AS uno,
  'Otra Cosa ' || c_custkey || '.' AS dos FROM customer)
"""


@query("gra_05_names", _SAID + "SELECT chunk_id, n.texto, n.inicio::BIGINT AS inicio, n.fin::BIGINT AS fin FROM (SELECT chunk_id, unnest([{'texto': 'Norte', 'inicio': 0, 'fin': 5}, {'texto': 'Sur', 'inicio': length(uno) - 4, 'fin': length(uno) - 1}, {'texto': 'Otra Cosa', 'inicio': length(uno) + 1, 'fin': length(uno) + 10}]) AS n FROM v)")
def _(t: Tables):
    found = _said(t).select("chunk_id", F.explode(graph.recogniser("falso")(F.col("texto"))).alias("n"))
    return found.select("chunk_id", "n.texto", "n.inicio", "n.fin")


@query("gra_08_mentions", _SAID + "SELECT chunk_id, doc_id, count(*) AS n FROM (SELECT chunk_id, doc_id, unnest(['Norte', 'Sur', 'Otra Cosa']) FROM v) GROUP BY 1, 2")
def _(t: Tables):
    return graph.mentions(_said(t)).groupBy("chunk_id", "doc_id").agg(F.count(F.lit(1)).alias("n"))


@query("gra_12_sentence_spans", _SAID + "SELECT chunk_id, 0 AS oracion, 0 AS desde, length(uno) AS hasta FROM v UNION ALL SELECT chunk_id, 1, length(uno) + 1, length(uno) + 1 + length(dos) FROM v")
def _(t: Tables):
    return graph.sentence_spans(_said(t))


@query("gra_14_triples", _SAID + "SELECT chunk_id, doc_id, CASE k WHEN 2 THEN 'sur' ELSE 'norte' END AS sujeto, ['opera', 'regula', 'financia'][k + 1] AS tipo, CASE k WHEN 2 THEN 'norte' ELSE 'sur' END AS objeto, uno AS evidencia FROM v WHERE k < 3")
def _(t: Tables):
    rows = _said(t)
    found = graph.mentions(rows)
    return graph.triples(found, graph.sentence_spans(rows), rows, graph.canonical(found)[1])


@query("gra_16_build", _MENTIONS + """
SELECT 'C:' || chunk_id AS src, 'E:' || id AS dst, 'MENCIONA' AS kind, n FROM top UNION ALL SELECT DISTINCT 'D:' || doc_id, 'C:' || chunk_id, 'CONTIENE', 1 FROM top
UNION ALL SELECT 'E:' || s, 'E:' || o, 'RELACION', 1 FROM rela""")
def _(t: Tables):
    return _graph(t)[2].select("src", "dst", "kind", "n")


@query("gra_17_summary", _MENTIONS + """
SELECT 'nodo entidad' AS clase, count(*) AS n FROM adm UNION ALL SELECT 'nodo fragmento', count(DISTINCT chunk_id) FROM top UNION ALL SELECT 'nodo documento', count(DISTINCT doc_id) FROM top
UNION ALL SELECT 'arista MENCIONA', count(*) FROM top UNION ALL SELECT 'arista CONTIENE', count(*) FROM (SELECT DISTINCT doc_id, chunk_id FROM top) UNION ALL SELECT 'arista RELACION', count(*) FROM rela HAVING count(*) > 0""")
def _(t: Tables):
    _, nodes, edges = _graph(t)
    return graph.summary(nodes, edges)


@query("gra_18_alias_index", _MENTIONS + "SELECT id AS clave, id FROM ent")
def _(t: Tables):
    return graph.alias_index(graph.canonical(_mentions(t))[0])


@query("gra_19_query_entities", "SELECT c_custkey % 50 AS query_id, 'part ' || (c_custkey % 300) AS id, min(c_custkey) AS ord FROM customer WHERE 'part ' || (c_custkey % 300) IN (SELECT 'part ' || CASE WHEN l_linenumber = 1 THEN l_partkey % 10 ELSE l_partkey END FROM lineitem) GROUP BY 1, 2")
def _(t: Tables):
    alias = graph.alias_index(graph.canonical(_mentions(t))[0])
    said = t.customer.select((F.col("c_custkey") % 50).alias("query_id"), F.col("c_custkey").alias("ord"), F.concat(F.lit("The PART "), F.col("c_custkey") % 300).alias("texto"))
    return graph.query_entities(said, alias)


@query("gra_20_rank", _MENTIONS + """
, want AS (SELECT range AS query_id, 'part ' || (range * 7) AS e FROM range(20)), sym AS (SELECT s, o FROM rela UNION SELECT o, s FROM rela),
w AS (SELECT query_id, e, max(w) AS w FROM (SELECT query_id, e, 1.0 AS w FROM want UNION ALL SELECT query_id, b.o, 0.35 FROM want JOIN sym b ON b.s = want.e) GROUP BY 1, 2),
sc AS (SELECT query_id, 'C:' || chunk_id AS chunk, round(sum(w * (1 + (n - 1) * 0.25)), 9)::DOUBLE AS score FROM w JOIN top ON top.id = w.e GROUP BY 1, 2)
SELECT query_id, chunk, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk) AS rank FROM sc) WHERE rank <= 50""")
def _(t: Tables):
    wanted = t.spark.range(20).select(F.col("id").alias("query_id"), F.concat(F.lit("part "), F.col("id") * 7).alias("id"))
    return graph.rank_by_entities(wanted, _graph(t)[2])


# pools and samples


@query("smp_01_pool", BASE + "SELECT query_id, chunk_id, string_agg(encoder || '=' || rank, ',' ORDER BY encoder) AS posiciones, min(rank) AS mejor FROM rankings WHERE rank <= 15 GROUP BY 1, 2")
def _(t: Tables):
    text = F.array_join(F.transform(F.map_entries("posiciones"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return sampling.pool(t.rankings()).select("query_id", "chunk_id", text.alias("posiciones"), "mejor")


@query("smp_02_annotation_pool", BASE + """
, p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, chunk_id ORDER BY enc_ord) AS n FROM rankings WHERE rank <= 20) WHERE n = 1),
a AS (SELECT query_id, query_id % 3 AS anotador FROM queries UNION ALL SELECT query_id, (query_id + 1) % 3 FROM queries WHERE query_id < floor((SELECT count(*) FROM queries) * 0.2))
SELECT query_id, chunk_id, encoder, rank, anotador FROM p JOIN a USING (query_id)""")
def _(t: Tables):
    return sampling.annotation_pool(t.rankings(), 3)


_GRADES = "WITH g AS (SELECT l_orderkey % 40 AS query_id, l_partkey % 60 AS chunk_id, l_suppkey % 9 AS doc_id, CASE l_linenumber WHEN 1 THEN '0' WHEN 2 THEN '1' WHEN 3 THEN ' 2 ' WHEN 4 THEN '' ELSE 'x' END AS grade FROM lineitem)"


def _annotated(t: Tables):
    n = F.col("l_linenumber")
    grade = F.when(n == 1, "0").when(n == 2, "1").when(n == 3, " 2 ").when(n == 4, "").otherwise("x")
    return t.lineitem.select((F.col("l_orderkey") % 40).alias("query_id"), (F.col("l_partkey") % 60).alias("chunk_id"), (F.col("l_suppkey") % 9).alias("doc_id"), grade.alias("grade"))


@query("smp_03_consolidate", _GRADES + " SELECT query_id, chunk_id, max(try_cast(trim(grade) AS DOUBLE)) AS grade FROM g WHERE try_cast(nullif(trim(grade), '') AS DOUBLE) IS NOT NULL GROUP BY 1, 2")
def _(t: Tables):
    return sampling.consolidate(_annotated(t))[0]


@query("smp_03_relevant_documents", _GRADES + " SELECT DISTINCT query_id, doc_id FROM g WHERE trim(grade) = '2'")
def _(t: Tables):
    return sampling.consolidate(_annotated(t))[1]


@query("smp_04_latest", BASE + """
, j AS (SELECT l_orderkey % 20 AS query_id, l_partkey % 500 AS chunk_id, (l_linenumber % 3)::DOUBLE AS grade, l_orderkey * 10 + l_linenumber AS ord FROM lineitem)
SELECT query_id, chunk_id, arg_max(grade, ord) AS grade FROM j SEMI JOIN (SELECT query_id, chunk_id FROM rankings WHERE rank <= 15) p USING (query_id, chunk_id) GROUP BY 1, 2""")
def _(t: Tables):
    judged = t.lineitem.select(
        (F.col("l_orderkey") % 20).alias("query_id"), (F.col("l_partkey") % 500).alias("chunk_id"), (F.col("l_linenumber") % 3).cast("double").alias("grade"),
        F.lit(False).alias("doc"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
    )
    return sampling.consolidate_latest(sampling.pool(t.rankings()), judged)[0]


@query("smp_05_batches", BASE + "SELECT DISTINCT query_id, query_id // 5 + 1 AS lote FROM rankings")
def _(t: Tables):
    return sampling.batches(sampling.pool(t.rankings())).select("query_id", "lote").distinct()


@query("smp_06_doc_stats", BASE + "SELECT doc_id, count(*) AS fragmentos, arg_min(fenomeno, chunk_id) AS fenomeno, arg_min(fuente, chunk_id) AS fuente FROM chunks GROUP BY 1")
def _(t: Tables):
    return sampling.doc_stats(t.chunks())


_JUDGED = "judged AS (SELECT DISTINCT q.doc_id, q.chunk_id FROM qrels q JOIN rankings r USING (query_id, chunk_id) WHERE grade = 2 AND rank <= 5)"


def _judged(t: Tables):
    """Relevant ones among the five best of each query and index."""
    return t.qrels().filter("grade = 2").join(t.rankings().filter("rank <= 5"), ["query_id", "chunk_id"]).select("doc_id", "chunk_id").distinct()


@query("smp_07_mandatory", BASE + f", {_JUDGED} SELECT doc_id FROM judged UNION SELECT doc_id FROM chunks WHERE fuente = 's1'")
def _(t: Tables):
    return sampling.mandatory(t.chunks().filter("fuente = 's1'"), _judged(t))


@query("smp_08_hard_negatives", BASE + f""", {_JUDGED},
b AS (SELECT doc_id, min(rank) AS mejor FROM rankings r JOIN chunks c USING (chunk_id) WHERE doc_id NOT IN (SELECT doc_id FROM judged) GROUP BY 1),
s AS (SELECT *, row_number() OVER w AS i, coalesce(sum(n) OVER (ORDER BY mejor, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM b JOIN (SELECT doc_id, count(*) AS n FROM chunks GROUP BY 1) USING (doc_id) WINDOW w AS (ORDER BY mejor, doc_id))
SELECT doc_id, mejor, n AS fragmentos FROM s WHERE i <= 25 AND upto < 60""")
def _(t: Tables):
    return sampling.hard_negatives(t.named(), _judged(t).select("doc_id").distinct(), sampling.doc_stats(t.chunks()), 25, 60)


@query("smp_09_stratified", """
WITH d AS (SELECT o_orderkey AS doc_id, o_orderstatus AS fenomeno, o_orderpriority AS formato, 1 + o_orderkey % 4 AS fragmentos, (o_orderkey * 7919) % 10007 AS orden FROM orders),
q AS (SELECT *, greatest(1, round_even(10.0::DOUBLE * count(*) OVER (PARTITION BY fenomeno, formato) / count(*) OVER (), 0)) AS quota, row_number() OVER (PARTITION BY fenomeno, formato ORDER BY orden, doc_id) AS rn FROM d),
r AS (SELECT *, floor((rn - 1) / quota)::BIGINT AS ronda FROM q),
s AS (SELECT *, coalesce(sum(fragmentos) OVER (ORDER BY ronda, fenomeno, formato, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM r)
SELECT doc_id, fenomeno, formato, ronda FROM s WHERE upto < 500""")
def _(t: Tables):
    k = F.col("o_orderkey")
    docs = t.orders.select(k.alias("doc_id"), F.col("o_orderstatus").alias("fenomeno"), F.col("o_orderpriority").alias("formato"), (1 + k % 4).alias("fragmentos"), (k * 7919 % 10007).alias("orden"))
    return sampling.stratified(docs, 500).select("doc_id", "fenomeno", "formato", "ronda")


@query("smp_10_coverage", BASE + f", {_JUDGED} SELECT count(*) AS juicios, count(*) FILTER (doc_id < 60) AS juicios_dentro, count(DISTINCT doc_id) AS docs, count(DISTINCT CASE WHEN doc_id < 60 THEN doc_id END) AS docs_dentro FROM judged")
def _(t: Tables):
    j = _judged(t)
    return sampling.coverage(t.spark.range(60).select(F.col("id").alias("doc_id")), j, j)


# sources and sinks


@query("src_01_catalogue", """
SELECT s_suppkey, printf('F%d-%s-%03d', 1 + s_suppkey % 3, upper(left(n_name, 3)), row_number() OVER (PARTITION BY s_suppkey % 3, upper(left(n_name, 3)) ORDER BY s_suppkey)) AS doc_id, 'pdf' AS formato
FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def _(t: Tables):
    codes = t.nation.select(F.col("n_name").alias("observatorio"), F.upper(F.left("n_name", F.lit(3))).alias("codigo"))
    inv = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("s_suppkey").alias("fila"), (1 + F.col("s_suppkey") % 3).alias("fenomeno"), F.col("n_name").alias("observatorio"), F.concat("s_name", F.lit(".PDF")).alias("fuente"),
    )
    return readers.catalogue(inv, codes).select("s_suppkey", "doc_id", "formato")


@query("src_04_needs_ocr", "SELECT doc_id FROM documents WHERE length(trim(text, ' ' || chr(10) || chr(9))) < 200")
def _(t: Tables):
    return t.documents.filter(readers.needs_ocr(F.col("text"))).select("doc_id")


@query("src_08_flatten_json", """
SELECT event_id, array_to_string(list_transform(list_filter(json_keys(props), lambda k: coalesce(json_extract_string(props, '$.' || k), '') <> ''), lambda k: k || ': ' || json_extract_string(props, '$.' || k)), chr(10)) AS texto
FROM events""")
def _(t: Tables):
    return t.events.select("event_id", readers.flatten_json("props").alias("texto"))


@query("src_05_json_document", "SELECT page_id, 'articulo' AS clase, array_to_string(list_filter([url, CASE WHEN coalesce(html, '') = '' THEN 'fin' ELSE html || chr(10) || 'fin' END], lambda x: coalesce(x, '') <> ''), chr(10) || chr(10)) AS texto FROM pages")
def _(t: Tables):
    body = F.to_json(F.struct(F.col("url").alias("title"), F.array(F.col("html"), F.lit("fin")).alias("content")))
    return t.pages.select("page_id", readers.json_document(body).alias("d")).select("page_id", "d.clase", "d.texto")


@query("src_11_row_text", "SELECT n_nationkey::BIGINT AS n_nationkey, 'n_nationkey: ' || n_nationkey || ' | n_name: ' || n_name || ' | n_regionkey: ' || n_regionkey AS texto FROM nation")
def _(t: Tables):
    return t.nation.select("n_nationkey", T.row_text(["n_nationkey", "n_name", "n_regionkey"]).alias("texto"))


@query("src_12_tile_features", "SELECT doc_id, trim(raw) AS linea, min(i) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE trim(raw) <> '' GROUP BY 1, 2")
def _(t: Tables):
    rows = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "raw")).withColumn("linea", T.strip(F.col("raw")))
    return rows.filter("linea <> ''").groupBy("doc_id", "linea").agg((F.min("i") + 1).alias("n"))


@query("src_18_pending_ocr", "SELECT doc_id FROM documents WHERE n_chars < 400 AND doc_id % 3 > 0")
def _(t: Tables):
    docs = t.documents.select("doc_id", (F.col("n_chars") < 400).alias("necesita_ocr"))
    return readers.pending_ocr(docs, docs.filter("doc_id % 3 = 0"))


@query("src_19_apply_ocr", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'ocr ' || doc_id ELSE text END AS texto, n_chars < 400 AND doc_id % 3 > 0 AS necesita_ocr FROM documents")
def _(t: Tables):
    docs = t.documents.select("doc_id", F.col("text").alias("texto"), (F.col("n_chars") < 400).alias("necesita_ocr"))
    return readers.apply_ocr(docs, docs.filter("doc_id % 3 = 0").select("doc_id", F.concat(F.lit("ocr "), "doc_id").alias("texto")))


@query("src_20_queries_text", "SELECT printf('q%03d', conv_id) AS query_id, trim(regexp_replace(string_agg(text, ' ' ORDER BY turn), '\\s+', ' ', 'g')) AS texto FROM conversations WHERE text IS NOT NULL AND trim(text) <> '' GROUP BY conv_id")
def _(t: Tables):
    rows = t.conversations.filter("trim(text) <> ''")
    head = rows.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("turn"), F.format_string("Q%03d", "conv_id").alias("linea"))
    lines = head.unionByName(rows.select("conv_id", "turn", F.concat(F.lit(" "), F.regexp_replace("text", r"(?U)\s+", " ")).alias("linea")))
    lines = lines.withColumn("n", F.col("conv_id") * 1000 + F.col("turn") + 1)
    return readers.queries_of_text(lines.select("n", "linea"))


@query("src_21_queries_json", "SELECT lower('Q' || c_custkey) AS query_id, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS texto FROM customer")
def _(t: Tables):
    even = F.col("c_custkey") % 2 == 0
    rows = t.customer.select(F.concat(F.lit("Q"), "c_custkey").alias("query_id"), F.when(even, F.col("c_name")).otherwise("  ").alias("texto"), F.col("c_mktsegment").alias("query"))
    return readers.queries_of_json(rows)


@query("src_25_encoders", "SELECT unnest(['a', 'b']) AS encoder")
def _(t: Tables):
    return readers.encoders_of(t.rankings())


@query("src_27_judgments", BASE + "SELECT query_id, chunk_id, grade FROM qrels")
def _(t: Tables):
    q = t.qrels()
    return readers.judgments(sinks.ground_truth(q.select("query_id", "chunk_id", "grade"), q.select("query_id", "doc_id")))[0]


@query("src_31_ranking_cache", BASE + "SELECT query_id, encoder, rank, chunk_id, round(sim, 6) AS sim FROM rankings")
def _(t: Tables):
    return readers.ranking_rows(sinks.ranking_cache(t.rankings()))


@query("src_32_source_first", BASE + "SELECT doc_id, arg_min(fuente, chunk_id) AS fuente FROM chunks GROUP BY 1")
def _(t: Tables):
    return readers.source_of_documents(t.chunks())


@query("src_34_source_last", "SELECT doc_id, arg_max(source, id) AS fuente FROM (SELECT doc_id // 3 AS doc_id, doc_id AS id, source FROM documents) GROUP BY 1")
def _(t: Tables):
    rows = t.documents.select(F.floor(F.col("doc_id") / 3).alias("doc_id"), F.col("doc_id").alias("chunk_id"), F.col("source").alias("fuente"))
    return readers.source_of_documents(rows, last=True)


@query("src_35_first_encoder", BASE + "SELECT DISTINCT chunk_id, doc_id, fuente FROM rankings JOIN chunks USING (chunk_id) WHERE encoder = 'a'")
def _(t: Tables):
    return readers.first_encoder(t.named(), "doc_id", "fuente")


@query("src_37_count", "SELECT count(*) AS n FROM documents")
def _(t: Tables):
    return readers.count_rows(t.documents)


@query("snk_06_entity_cache", _MENTIONS.split("form AS")[0].rstrip().rstrip(",") + " SELECT chunk_id, doc_id, count(*) AS n FROM m GROUP BY 1, 2")
def _(t: Tables):
    return sinks.entity_cache(_mentions(t)).select("chunk_id", "doc_id", F.size("menciones").alias("n"))


@query("snk_09_filled", "SELECT p_partkey, coalesce(CASE WHEN p_partkey % 3 > 0 THEN p_name END, '') AS nombre FROM part")
def _(t: Tables):
    return sinks.filled(t.part.select("p_partkey", F.when(F.col("p_partkey") % 3 > 0, F.col("p_name")).alias("nombre")))


@query("snk_13_ground_truth", BASE + "SELECT query_id, count(*) AS fragmentos, count(DISTINCT doc_id) AS documentos FROM qrels GROUP BY 1")
def _(t: Tables):
    q = t.qrels()
    out = sinks.ground_truth(q.select("query_id", "chunk_id", "grade"), q.select("query_id", "doc_id"))
    return out.select("query_id", F.size("fragmentos").alias("fragmentos"), F.size("documentos").alias("documentos"))


@query("snk_15_catalogue_report", """
SELECT 'total' AS medida, count(*) AS n FROM documents UNION ALL SELECT 'en_disco', count(*) FROM documents WHERE source < 'src5' UNION ALL SELECT 'doc_id_repetidos', 0
UNION ALL SELECT 'fuentes_repetidas', count(*) FROM (SELECT source FROM documents GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'ausentes', count(*) FROM documents WHERE NOT source < 'src5'""")
def _(t: Tables):
    docs = t.documents.select("doc_id", F.col("source").alias("fuente"))
    return readers.catalogue_report(docs, docs.filter("fuente < 'src5'"))


@query("src_29_judged_texts", "SELECT conv_id AS chunk_id, arg_max(text, turn) AS texto FROM conversations GROUP BY 1")
def _(t: Tables):
    return readers.judged_texts(t.conversations.select(F.col("conv_id").alias("chunk_id"), F.col("turn").alias("ord"), F.col("text").alias("texto")))


@query("src_36_first_fragments", BASE + "SELECT chunk_id, doc_id, fuente FROM chunks ORDER BY chunk_id LIMIT 25")
def _(t: Tables):
    return readers.first_fragments(None, t.chunks().select("chunk_id", "doc_id", "fuente"), 25)


@query("snk_12_aligned", "SELECT 'a' AS encoder, count(*) AS vectores, count(*) AS filas, true AS alineado FROM embeddings UNION ALL SELECT 'b', count(*), count(*) FILTER (vec_id > 9), false FROM embeddings")
def _(t: Tables):
    ids = t.embeddings.select("vec_id")
    both = ids.withColumn("encoder", F.lit("a")).unionByName(ids.withColumn("encoder", F.lit("b")))
    return sinks.aligned(both, both.filter("encoder = 'a' OR vec_id > 9"))


@query("smp_11_recover", BASE + "SELECT DISTINCT doc_id, CASE WHEN doc_id < 60 THEN fuente ELSE 'crudo' END AS fuente, doc_id < 60 AS indexado FROM chunks")
def _(t: Tables):
    docs = sampling.doc_stats(t.chunks()).select("doc_id", "fuente")
    return readers.recover(docs, docs.filter("doc_id < 60"), docs.withColumn("fuente", F.lit("crudo")))


@query("txt_07_clean_section", f"""WITH {_NORMAL}, {_BAD},
rows AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM normal),
left_over AS (SELECT r.doc_id, string_agg(r.raw, chr(10) ORDER BY r.i) AS t FROM rows r ANTI JOIN bad b ON b.doc_id = r.doc_id AND b.line = trim(r.raw)
  WHERE NOT regexp_full_match(r.raw, '[^\\p{{L}}_]{{0,12}}') OR trim(r.raw) = '' GROUP BY 1)
SELECT doc_id, {_TIDY.format('t')} AS texto FROM normal LEFT JOIN left_over USING (doc_id)""")
def _(t: Tables):
    docs = _docs(t)
    bad = T.boilerplate(docs, "doc_id", "texto").groupBy("doc_id").agg(F.collect_set("line").alias("bad"))
    rows = docs.join(bad, "doc_id", "left").withColumn("bad", F.coalesce("bad", F.array().cast("array<string>")))
    return rows.select("doc_id", T.clean_section(F.col("texto"), F.col("bad")).alias("texto"))


@query("chk_09_sections")
def _(t: Tables):
    docs = _sections(t).select(F.col("conv_id").alias("doc_id"), F.lit("pdf").alias("formato"), F.lit("").alias("texto"), "secciones")
    return chunking.chunk_sections(docs, budget=100)


@query("gra_21_channel", _MENTIONS + """
, want AS (SELECT range AS query_id, 'part ' || (range * 7) AS e FROM range(20)), sym AS (SELECT s, o FROM rela UNION SELECT o, s FROM rela),
w AS (SELECT query_id, e, max(w) AS w FROM (SELECT query_id, e, 1.0 AS w FROM want UNION ALL SELECT query_id, b.o, 0.35 FROM want JOIN sym b ON b.s = want.e) GROUP BY 1, 2),
sc AS (SELECT query_id, chunk_id, round(sum(w * (1 + (n - 1) * 0.25)), 9)::DOUBLE AS sim FROM w JOIN top ON top.id = w.e GROUP BY 1, 2),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, 'C:' || chunk_id) AS r FROM sc) WHERE r <= 50)
SELECT query_id, chunk_id, sim, row_number() OVER (PARTITION BY query_id ORDER BY r) AS rank FROM best WHERE chunk_id IN (SELECT vec_id FROM embeddings)""")
def _(t: Tables):
    wanted = t.spark.range(20).select(F.col("id").alias("query_id"), F.concat(F.lit("part "), F.col("id") * 7).alias("id"))
    out = graph.as_ranking(graph.rank_by_entities(wanted, _graph(t)[2]), t.chunks())
    return out.select("query_id", "chunk_id", "sim", "rank")
