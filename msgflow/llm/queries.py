"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.llm import collocations, decontaminate, fingerprints, hidden_markov, jaccard_join, language_id, line_dedup, mixing, packing, periodic_runs, sharding, site_quality, toxicity
from msgflow.llm.common import remainder, table
from msgflow.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]

WORD_SQL = r"'[^\x20\x09-\x0D]+'"

LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM (SELECT DISTINCT doc_id, text FROM documents)),
solid AS (
  SELECT doc_id, text, line, pos, row_number() OVER (PARTITION BY doc_id, text ORDER BY pos) - 1 AS k
  FROM lines WHERE regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g') <> ''),
windows AS (
  SELECT doc_id, text, k, line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS body
  FROM solid WINDOW w AS (PARTITION BY doc_id, text ORDER BY k)),
later AS (
  SELECT doc_id, text, k FROM windows WHERE body IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, k) > 1),
gone AS (SELECT DISTINCT doc_id, text, k + unnest([0, 1, 2]) AS k FROM later),
parts AS (
  SELECT l.doc_id, l.text, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.k IS NULL) AS t,
         count(g.k) AS n_removed
  FROM lines l LEFT JOIN solid s USING (doc_id, text, pos)
  LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.text = s.text AND g.k = s.k
  GROUP BY 1, 2)
SELECT d.doc_id, coalesce(p.t, '') AS text_deduped, len(string_split(d.text, chr(10)))::BIGINT AS n_lines,
       p.n_removed::BIGINT AS n_removed
FROM documents d JOIN parts p ON p.doc_id = d.doc_id AND p.text = d.text
"""


@query("op1_hidden_markov")
def op1_hidden_markov(spark: SparkSession, base: str) -> DataFrame:
    return hidden_markov.score(table(spark, base, "documents"), held_out=remainder(F.col("doc_id"), 10) == 0)


@query("op2_line_windows", LINES_SQL)
def op2_line_windows(spark: SparkSession, base: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, base, "documents"))
    return out.select("doc_id", "text_deduped", "n_lines", "n_removed")


@query("op3_hilbert_shards")
def op3_hilbert_shards(spark: SparkSession, base: str) -> DataFrame:
    dimensions = {"lang": F.col("lang"), "source": F.col("source"), "n_chars": F.col("n_chars")}
    return sharding.hilbert_shards(table(spark, base, "documents"), dimensions, shards=24)


MIX_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {WORD_SQL})), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 10))::BIGINT AS draw
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
rounds(n, source, source_size, w, capped) AS (
  SELECT 0, source, source_size, w, false FROM s
  UNION ALL
  SELECT n + 1, source, source_size, w,
         capped OR 2 * source_size <= (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) FILTER (WHERE capped) OVER (), 0))
                                    * w / nullif(coalesce(sum(w) FILTER (WHERE NOT capped) OVER (), 0), 0)
  FROM rounds WHERE n < 200),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN (2 * source_size)::DOUBLE
              ELSE ((3 * sum(source_size) OVER () - 2 * coalesce(sum(2 * source_size) FILTER (WHERE capped) OVER (), 0)) * w)::DOUBLE
                   / (2 * sum(w) FILTER (WHERE NOT capped) OVER ())::DOUBLE END AS target
  FROM rounds WHERE n = 200),
o AS (
  SELECT doc_id, d.source, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((whole + CASE WHEN before + size / 2.0 < target - whole * source_size THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM o
"""


@query("op6_water_filling", MIX_SQL)
def op6_water_filling(spark: SparkSession, base: str) -> DataFrame:
    mixed = mixing.mix(table(spark, base, "documents"), weights=(5, 2, 1), share=(3, 2), max_epochs=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


CONTAINED_SQL = rf"""
WITH w AS (
  SELECT 0 AS kind, doc_id AS id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORD_SQL}) AS w FROM documents
  UNION ALL
  SELECT 1, item_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORD_SQL}) FROM benchmark),
s AS (
  SELECT DISTINCT kind, id, text, array_to_string(w[i:i + 4], ' ') AS h
  FROM (SELECT kind, id, text, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT id, text, count(*) AS n FROM s WHERE kind = 1 GROUP BY 1, 2),
j AS (
  SELECT d.id AS doc_id, d.text, b.id AS item_id, b.text AS item, count(*) AS n_shared
  FROM s d JOIN s b ON d.h = b.h AND d.kind = 0 AND b.kind = 1 GROUP BY 1, 2, 3, 4)
SELECT doc_id, item_id, n::BIGINT AS n_item, n_shared::BIGINT AS n_shared, n_shared / n AS containment
FROM j JOIN n ON j.item_id = n.id AND j.item = n.text WHERE n_shared * 1000 >= n * 750
"""


@query("op9_containment", CONTAINED_SQL)
def op9_containment(spark: SparkSession, base: str) -> DataFrame:
    pairs = decontaminate.contained(table(spark, base, "documents"), table(spark, base, "benchmark"))
    return pairs.select("doc_id", "item_id", "n_item", "n_shared", "containment")


@query("op10_paragraph_sketches")
def op10_paragraph_sketches(spark: SparkSession, base: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, base, "documents"))


@query("op4_byte_network")
def op4_byte_network(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    model = language_id.train(docs, label=F.col("lang"), learn=~held_out)
    out = language_id.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score")


@query("op5_toxic_segments")
def op5_toxic_segments(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = toxicity.train(docs, table(spark, base, "labels"), learn=~held_out)
    return toxicity.detect(docs.select("doc_id", "text", held_out.alias("held_out")), model, 0.3, ["doc_id", "held_out"])


@query("op7_site_quality")
def op7_site_quality(spark: SparkSession, base: str) -> DataFrame:
    """Hosts are sources; a source's languages are its sections."""
    docs, labels = table(spark, base, "documents"), table(spark, base, "labels")
    return site_quality.site_quality(docs, labels, host=F.col("source"), path=F.col("lang"))


@query("op8_partenum_join")
def op8_partenum_join(spark: SparkSession, base: str) -> DataFrame:
    return jaccard_join.linked(table(spark, base, "documents"))


@query("op11_configuration_packing")
def op11_configuration_packing(spark: SparkSession, base: str) -> DataFrame:
    vocabulary = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")
    return packing.pack(table(spark, base, "documents").select("doc_id", "text"), vocabulary, capacity=4096, end_id=1)


PHRASE_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS f
  FROM (SELECT lang, w, i, unnest([1, 2, 3, 4]) AS k FROM i) WHERE i + k - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, phrase, string_split(phrase, ' ') AS g, k, f FROM g WHERE f >= 30),
u AS (
  SELECT lang, phrase, f AS a, cut, array_to_string(g[1:cut], ' ') AS head, array_to_string(g[cut + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c WHERE k >= 2)),
s AS (
  SELECT u.lang, u.phrase, u.a, u.cut, x.f AS l, y.f AS r, (2000000::HUGEINT * u.a) // (x.f::HUGEINT + y.f) AS score
  FROM u JOIN c x ON x.lang = u.lang AND x.phrase = u.head JOIN c y ON y.lang = u.lang AND y.phrase = u.rest),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
v AS (SELECT lang, g, f, k, unnest(range(2, k)) AS m FROM c WHERE k >= 3),
h AS (
  SELECT lang, phrase, max(f) AS longer
  FROM (SELECT lang, f, array_to_string(g[j:j + m - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, k - m + 2)) AS j FROM v)) GROUP BY 1, 2),
o AS (
  SELECT b.* FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE h.longer IS NULL OR 100::HUGEINT * h.longer < 80::HUGEINT * b.a),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM t JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op12_collocations", PHRASE_SQL)
def op12_collocations(spark: SparkSession, base: str) -> DataFrame:
    return collocations.collocations(table(spark, base, "documents").select("lang", "text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "text")
    return periodic_runs.digests(periodic_runs.periodic_runs(docs, ["doc_id"], prepare=periodic_runs.planted))
