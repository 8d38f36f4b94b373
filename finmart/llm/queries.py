"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from finmart.llm.byte_bpe import digests, encode_documents
from finmart.llm.collocations import collocations
from finmart.llm.decontamination import contamination, contamination_report
from finmart.llm.embedding_dedup import embedding_components
from finmart.llm.jaccard_join import jaccard_components
from finmart.llm.language_id import language_predictions
from finmart.llm.license_scan import licence_matches, licence_report
from finmart.llm.masked_lm import pseudo_likelihoods
from finmart.llm.mixing import mix_sources
from finmart.llm.periodic_runs import periodic_runs, repeated_tail, run_report
from finmart.llm.quality_rules import quality_verdicts
from finmart.llm.token_counts import token_counts
from finmart.llm.toxicity import toxicity_scores


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_read(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(_read(spark, sf_dir, "embeddings"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_report(licence_matches(_read(spark, sf_dir, "documents")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_predictions(_read(spark, sf_dir, "documents"))


def op8_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihoods(_read(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_documents(_read(spark, sf_dir, "documents"), with_decoded=True))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_read(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_read(spark, sf_dir, "documents"))


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    begin, part = repeated_tail(F.col("doc_id"))
    return run_report(periodic_runs(_read(spark, sf_dir, "documents"), repeat_from=begin, repeat_part=part))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_license_scan": op4_license_scan,
    "op5_mixing": op5_mixing,
    "op6_toxicity": op6_toxicity,
    "op7_language_id": op7_language_id,
    "op8_masked_lm": op8_masked_lm,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_token_counts": op10_token_counts,
    "op11_collocations": op11_collocations,
    "op12_winnowing": op12_winnowing,
    "op13_periodic_runs": op13_periodic_runs,
}
#: Words are split and lower-cased at ASCII characters only, hence no lower().
_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+')"""
#: Trained or certified decisions, tokenizers and Newton steps are tested by brute force instead.
ORACLES: dict[str, str] = {
    "op1_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS g FROM (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.c + y.c - k)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a AS doc_id, min(b) AS low FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(c, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op2_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT *, sqrt(list_dot_product(e, e)) AS size FROM v WHERE isfinite(list_sum(e)) AND list_dot_product(e, e) > 0),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_dot_product(x.e, y.e) / x.size / y.size >= 0.98),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a AS vec_id, min(b) AS low FROM r GROUP BY 1),
k AS (SELECT a AS vec_id, count(*) AS c FROM l GROUP BY 1)
SELECT vec_id, coalesce(c, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN m USING (vec_id) LEFT JOIN k USING (vec_id)""",
    # phrases of 2 to 5 words by position, every cut looked up; HUGEINT products are exact
    "op11_collocations": r"""
WITH t AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents
  WHERE text IS NOT NULL),
p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS words FROM t),
g AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM p),
f AS MATERIALIZED (SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS c
  FROM g, range(1, 6) AS sizes(k) WHERE i + k - 1 <= len(words) GROUP BY ALL),
n AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
c AS MATERIALIZED (SELECT lang, phrase, k, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND c >= 100),
i AS (SELECT DISTINCT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, a
  FROM c, range(2, 5) AS lengths(m), range(1, 5) AS firsts(s) WHERE m < k AND s + m - 1 <= k),
v AS MATERIALIZED (SELECT lang, phrase, c FROM f WHERE c >= 100),
u AS MATERIALIZED (SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
  FROM c, range(1, 5) AS cuts(cut) WHERE cut < k),
s AS (SELECT u.lang, u.phrase, a, cut, l.c AS l, r.c AS r, n.n,
    ((1000::HUGEINT * a * n.n) // (l.c::HUGEINT * r.c))::BIGINT AS score
  FROM u JOIN n ON n.lang = u.lang
  JOIN v l ON l.lang = u.lang AND l.phrase = u.head JOIN v r ON r.lang = u.lang AND r.phrase = u.tail),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM b ANTI JOIN i USING (lang, phrase, a))
SELECT * FROM o WHERE rank <= 2000""",
    # every window of every item compared as text
    "op12_winnowing": r"""
WITH w AS (SELECT row_number() OVER () AS d, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE item_id IS NOT NULL),
x AS (SELECT DISTINCT item, least(len(words), 10) AS k, array_to_string(words[i:i + 9], ' ') AS win
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
p AS (SELECT d, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: {'i': i, 'win': array_to_string(words[i:i + k - 1], ' ')})) AS at
  FROM w, (SELECT DISTINCT k FROM x)),
h AS (SELECT d, p.at.i AS i, p.k, item FROM p JOIN x ON x.k = p.k AND x.win = p.at.win),
c AS (SELECT d, count(DISTINCT j) AS n_hit FROM (SELECT d, unnest(range(i, i + k)) AS j FROM h) GROUP BY 1),
m AS (SELECT d, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY 1)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c USING (d) LEFT JOIN m USING (d)""",
}
