"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import compression_quality, hamming_topk, jaccard_trie, langid_hd, license_templates, line_windows, mixing
from . import hard_negatives, lm_scoring, packing, passages, spelling_variants, weak_rules

TOKENIZER = "word_bpe_49k.json"
MIX = mixing.Mix(
    weights=({"domain0": 400, "domain1": 300, "domain2": 200, "domain3": 100},
             {"en": 600, "de": 150, "fr": 150, "es": 100}, {}),
    default_weights=(100, 50, 100), budget_percent=60, max_epochs=2, seed=7)
NEIGHBOURS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def source_domain(source: str = "source"):
    """Domain of a source: its number, modulo four."""
    number = F.regexp_extract(F.col(source), "([0-9]{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), (number.cast("int") % 4).cast("string")))


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = langid_hd.held_out("doc_id", 3, 1)
    prototypes = langid_hd.train_prototypes(docs.where(~kept))
    return langid_hd.predict(docs, prototypes).select("doc_id", kept.alias("held_out"), "lang_pred", "score")


def op2_substring_dedup(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op3_mixing(spark, sf_dir):
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), source_domain(), MIX)
    return mixed.select(
        "doc_id", F.col("mx_epoch").cast("bigint").alias("epoch"), F.col("mx_domain").alias("domain"),
        F.col("mx_lang").alias("leaf_lang"), F.col("mx_source").alias("leaf_source"),
        F.col("mx_tokens").alias("n_tokens"))


def op4_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = langid_hd.held_out("doc_id", 5, 0)
    model = compression_quality.train(docs, table(spark, sf_dir, "labels").where(~kept))
    return compression_quality.score(docs, model).select(
        "doc_id", kept.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_ngram_jaccard_join(spark, sf_dir):
    return jaccard_trie.linked_components(table(spark, sf_dir, "documents"), width=4, percent=85)


def op6_line_dedup(spark, sf_dir):
    return line_windows.drop_repeated_windows(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", F.col("ln_removed").alias("n_removed"))


def op7_license_scan(spark, sf_dir):
    return license_templates.scan(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark, sf_dir):
    judged = weak_rules.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        "doc_id", F.col("q_n_words").alias("n_words"), F.col("q_word_chars").alias("word_chars"),
        F.col("q_n_symbols").alias("n_symbols"), F.col("q_n_dup_lines").alias("n_dup_lines"),
        F.col("q_n_repeat_words").alias("n_repeat_words"), F.col("q_base_failed").alias("base_failed"),
        F.col("q_kept").alias("kept"), F.col("q_posterior").alias("posterior"))


def op9_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op10_exact_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return hamming_topk.top_k(spark, vectors, F.col("vec_id") % 50 == 0, NEIGHBOURS)


def op11_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return lm_scoring.score(spark, docs, langid_hd.held_out("doc_id", 7, 2))


def op12_spelling_variants(spark, sf_dir):
    return spelling_variants.forms(spark, table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(spark, table(spark, sf_dir, "embeddings"), null_ids=True)


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_language_id, op2_substring_dedup, op3_mixing, op4_quality_classifier, op5_ngram_jaccard_join,
             op6_line_dedup, op7_license_scan, op8_quality_rules, op9_packing, op10_exact_topk, op11_lm_scoring, op12_spelling_variants,
             op13_hard_negatives, pipeline)
    return {q.__name__: q for q in found}


WORD = r"[^\x20\x09-\x0D]+"

_LEVELS = "domain, leaf_lang, leaf_source".split(", ")


def _weight(column: str, names, default: int) -> str:
    cases = " ".join(f"WHEN '{n}' THEN {w}" for n, w in sorted(names.items()))
    return f"CASE {column} {cases} ELSE {default} END" if cases else str(default)


def _level(depth: int) -> str:
    """One level of the budget tree."""
    name, above = _LEVELS[depth], _LEVELS[:depth]
    keys, by = ", ".join([*above, name]), ", ".join(above) or "1"
    join = f"JOIN given{depth} USING ({', '.join(above)})" if above else "CROSS JOIN given0"
    return f"""
  node{depth} AS (
    SELECT {keys}, sum(tokens) * {MIX.max_epochs} AS capacity,
      {_weight(name, MIX.weights[depth], MIX.default_weights[depth])} AS weight
    FROM leaf GROUP BY {keys}),
  level{depth} AS (
    SELECT *, capacity / weight AS ratio, (given{depth} - coalesce(sum(capacity) OVER (PARTITION BY {by}
        ORDER BY capacity / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rest,
      sum(weight) OVER (PARTITION BY {by} ORDER BY capacity / weight, {name}
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS heavy
    FROM node{depth} {join}),
  first{depth} AS (
    SELECT *, min({{'ratio': ratio, 'name': {name}, 'rest': rest, 'heavy': heavy}})
        FILTER (rest * weight < capacity * heavy) OVER (PARTITION BY {by}) AS first
    FROM level{depth}),
  given{depth + 1} AS (
    SELECT {keys}, CASE WHEN first IS NULL OR ratio < first.ratio THEN capacity
      ELSE least(first.rest * weight // first.heavy, capacity) END::BIGINT AS given{depth + 1}
    FROM first{depth})"""


def _mixing_sql() -> str:
    keys = ", ".join(_LEVELS)
    levels = ",".join(_level(d) for d in range(3))
    order = (f"('0x' || substr(md5('{MIX.seed}:' || whole || ':' || doc_id), 1, {mixing.ORDER_BITS // 4}))::BIGINT")
    return f"""
WITH doc AS (
    SELECT doc_id, coalesce('domain' || (nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '')::INT % 4), 'unknown')
        AS domain, coalesce(lang, 'unknown') AS leaf_lang, coalesce(source, 'unknown') AS leaf_source,
      len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_tokens
    FROM documents),
  leaf AS (SELECT {keys}, sum(n_tokens)::BIGINT AS tokens FROM doc GROUP BY {keys}),
  given0 AS (SELECT floor(sum(tokens) * {MIX.budget_percent} / 100)::BIGINT AS given0 FROM leaf),{levels},
  plan AS (
    SELECT {keys}, tokens, given3 AS budget, given3 // greatest(tokens, 1) AS whole FROM leaf JOIN given3 USING ({keys})),
  placed AS (
    SELECT *, {order} AS place FROM doc JOIN plan USING ({keys})),
  run AS (
    SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY {keys} ORDER BY place
      RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed),
  cut AS (
    SELECT {keys}, max(place) AS last FROM run
    WHERE before < budget - whole * tokens AND n_tokens > 0 GROUP BY {keys}),
  taken AS (
    SELECT placed.*, whole + CASE WHEN place <= last THEN 1 ELSE 0 END AS epochs
    FROM placed LEFT JOIN cut USING ({keys}))
SELECT doc_id, unnest(range(epochs::BIGINT)) AS epoch, {keys}, n_tokens FROM taken WHERE epochs > 0"""


JACCARD_SQL = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
  s AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1),
      lambda i: array_to_string(w[i:i + 3], ' '))) AS g FROM w WHERE len(w) > 0),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  c AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g)
    WHERE a.doc_id <> b.doc_id GROUP BY ALL),
  link AS (
    SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
  reach AS (
    SELECT doc_id AS id, doc_id AS other FROM documents
    UNION SELECT id, b FROM reach JOIN link ON other = a)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach ON id = d.doc_id GROUP BY d.doc_id"""

LINES_SQL = f"""
WITH line AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
      unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
    FROM documents WHERE text IS NOT NULL),
  numbered AS (
    SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p
    FROM line WHERE regexp_matches(line, '{WORD}')),
  three AS (
    SELECT doc_id, p, line AS a, lead(line) OVER w AS b, lead(line, 2) OVER w AS c
    FROM numbered WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
  again AS (
    SELECT doc_id, p, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS k FROM three WHERE c IS NOT NULL),
  gone AS (
    SELECT DISTINCT doc_id, unnest([p, p + 1, p + 2]) AS p FROM again WHERE k > 1),
  cut AS (SELECT doc_id, i FROM numbered JOIN gone USING (doc_id, p)),
  rest AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM line ANTI JOIN cut USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(rest.text, '') END AS text,
  (SELECT count(*) FROM cut WHERE cut.doc_id = d.doc_id) AS n_removed
FROM documents d LEFT JOIN rest USING (doc_id)"""

TOPK_SQL = f"""
WITH code AS (
    SELECT vec_id, array_to_string(list_transform(range(1, 65),
      lambda i: CASE WHEN embedding[i] > 0 THEN '1' ELSE '0' END), '') AS code
    FROM embeddings WHERE embedding IS NOT NULL)
SELECT query_id, rank, neighbor_id, distance FROM (
    SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id, hamming(q.code, v.code)::BIGINT AS distance,
      row_number() OVER (PARTITION BY q.vec_id ORDER BY hamming(q.code, v.code), v.vec_id) AS rank
    FROM code q CROSS JOIN code v WHERE q.vec_id % 50 = 0)
WHERE rank <= {NEIGHBOURS}"""


_MINE = hard_negatives.Mining()
NEGATIVES_SQL = f"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % {_MINE.relabel_every} = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor({_MINE.scale} * x::DOUBLE)::BIGINT) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
  s AS (
    SELECT a.vec_id AS anchor_id, a.label AS anchor_label, v.vec_id AS id, v.label,
      coalesce(list_sum(list_transform(range(1, least(len(a.q), len(v.q)) + 1), lambda i: a.q[i] * v.q[i])), 0)::BIGINT
        AS score
    FROM v a JOIN v ON a.vec_id % {_MINE.anchor_every} = 0 AND v.vec_id <> a.vec_id),
  pos AS (
    SELECT anchor_id, anchor_label, id AS positive_id, score AS positive_score FROM (
      SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r FROM s
      WHERE label = anchor_label)
    WHERE r <= {_MINE.positives}),
  neg AS (
    SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
      row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
    FROM pos p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
      AND {_MINE.low_percent} * p.positive_score <= 100 * s.score AND 100 * s.score <= {_MINE.high_percent} * p.positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= {_MINE.negatives}"""


def oracle_sql() -> dict[str, str]:
    return {"op13_hard_negatives": NEGATIVES_SQL, "op3_mixing": _mixing_sql(), "op5_ngram_jaccard_join": JACCARD_SQL, "op6_line_dedup": LINES_SQL,
            "op10_exact_topk": TOPK_SQL}
