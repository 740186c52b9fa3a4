"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm import crf_language, decontaminate, jaccard_join, license_scan, mixing_lm, ordered_packing, packing, qda_quality, quality_rules, secret_scan, spelling_variants, token_counts, vector_codes
from tabprep.llm.staging import Scratch, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies by 3-word shingles at a similarity of 0.9."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=90)


OP1_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT r, doc_id, list_distinct(CASE
    WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS sh
  FROM w),
u AS (SELECT r, len(sh) AS n, unnest(sh) AS g FROM s),
linked AS (
  SELECT a.r AS x, b.r AS y FROM u a JOIN u b ON a.g = b.g
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach(x, y) AS (
  SELECT x, y FROM linked
  UNION SELECT reach.x, linked.y FROM reach JOIN linked ON reach.y = linked.x)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles,
       coalesce((SELECT min(t.doc_id) FROM reach JOIN s t ON t.r = reach.y WHERE reach.x = s.r), s.doc_id) AS component_id
FROM s
"""

def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the ids that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = crf_language.held_out(0, 5)
    field = crf_language.learned(docs.where(~out & F.col("doc_id").isNotNull()))
    rows = crf_language.identified(docs, field, keep=["doc_id"])
    return rows.select("doc_id", out.alias("held_out"), "lang_pred", "score", "n_switches")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    rows = packing.packed(table(spark, sf_dir, "documents"), capacity=1024, ending=2, with_ids=False)
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every encoded length: what a context limit of that length keeps of all documents."""
    return token_counts.limits(token_counts.histogram(table(spark, sf_dir, "documents")))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document: pattern hits and structurally confirmed keys and tokens."""
    rows = secret_scan.secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in secret_scan.BASE_KINDS]
    return rows.select("doc_id", *counts, F.sha2(written(of(*secret_scan.BASE_KINDS)), 256).alias("base_sha256"), written("secrets").alias("spans"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels of ids that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = crf_language.held_out(2, 4)
    vectors = Scratch(spark, "quality").write(qda_quality.with_statistics(docs.select("doc_id", "text"), keep=["doc_id"]))
    model = qda_quality.learned(vectors, labels.where(~out).select("doc_id", "quality"))
    rows = qda_quality.scored(vectors, model)
    return rows.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, learned from the ids that are not held out."""
    out = crf_language.held_out(2, 7)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (~out & F.col("doc_id").isNotNull()).alias("train"))
    rows = mixing_lm.language_model(docs)
    return rows.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of each document and the verdict of the rule cascade."""
    rows = quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP8_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM t),
g AS (
  SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
rep AS (
  SELECT r, count(DISTINCT i + k) AS n FROM (
    SELECT r, i, unnest(range(0, 5)) AS k FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1)
  GROUP BY r),
m AS (
  SELECT doc_id, text, ws, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         len(ls) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
         OR 2 * word_chars < 5 * n_words OR word_chars > 14 * n_words
         OR 10 * length(regexp_replace(text, '[^{quality_rules.CAPITALS}]+', '', 'g')) > 3 * word_chars
         OR 2 * length(regexp_replace(text, '[^!]+', '', 'g')) > n_words
         OR 10 * len(list_filter(ws, lambda x: NOT regexp_matches(x, '\p{{L}}'))) > 4 * n_words) AS kept
FROM b
"""


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of every document."""
    rows = license_scan.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ids = F.col("license_sentences")
    return rows.select("doc_id", F.size(ids).cast("long").alias("n_sentences"), F.array_join(ids, ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def _op9_sql() -> str:
    known = ", ".join(f"('{s}', '{name}')" for name, s in license_scan.SENTENCES.items())
    steps = []
    for k, (name, rule) in enumerate(license_scan.RULES):
        pattern = license_scan.pattern_of(rule)
        steps.append(f"s{k + 1} AS (SELECT * EXCLUDE (seq, names), regexp_replace(seq, '{pattern}', '+', 'g') AS seq, CASE WHEN regexp_matches(seq, '{pattern}') THEN list_append(names, '{name}') ELSE names END AS names FROM s{k})")
    space = license_scan.SPACE
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_replace(coalesce(text, ''), '(?i)SPDX-License-Identifier:[ \t]*', 'SPDX-License-Identifier ', 'g') AS text FROM documents),
v AS (SELECT r, 0 AS wrapped, text FROM d UNION ALL SELECT r, 1, regexp_replace(regexp_replace(text, '{license_scan.BLANK_LINE}', '.' || chr(10), 'g'), '{space}', ' ', 'g') FROM d),
p AS (SELECT r, wrapped, string_split(regexp_replace(regexp_replace(text, '([.!?;]){space}', '\1' || chr(10), 'g'), ':{space}([A-Z0-9])', ':' || chr(10) || '\1', 'g'), chr(10)) AS parts FROM v),
q AS (SELECT r, wrapped, i, trim(regexp_replace(lower(parts[i]), '[^a-z0-9]+', ' ', 'g')) AS s FROM (SELECT r, wrapped, parts, unnest(range(1, len(parts) + 1)) AS i FROM p)),
known(s, name) AS (VALUES {known}),
ids AS (SELECT r, wrapped, list(name ORDER BY i) AS ids FROM q JOIN known USING (s) GROUP BY r, wrapped),
s0 AS (SELECT r, wrapped, ids, array_to_string(ids, ',') || ',' AS seq, CAST([] AS VARCHAR[]) AS names FROM ids),
{", ".join(steps)},
best AS (SELECT r, arg_max(ids, len(ids) * 2 - wrapped) AS ids, list_sort(list_distinct(flatten(list(names)))) AS names FROM s{len(steps)} GROUP BY r)
SELECT d.doc_id, CAST(coalesce(len(best.ids), 0) AS BIGINT) AS n_sentences, coalesce(array_to_string(best.ids, ','), '') AS sentence_ids,
       coalesce(array_to_string(best.names, ','), '') AS licenses
FROM d LEFT JOIN best USING (r)
"""


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in a 10-word passage of a benchmark item."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rows = decontaminate.contamination(docs, items, window=10, keep=["doc_id"])
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    names = F.array_join(F.array_sort("hit_items"), ",")
    rows = rows.select("doc_id", "n_words", hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"))
    return rows.withColumn("contaminated", F.col("n_hit") > 0)


OP10_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, ws, least(len(ws), 10) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark) WHERE len(ws) > 0),
bw AS (
  SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT item, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM b)),
dw AS (
  SELECT r, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)),
m AS (SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
h AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT r, i, unnest(range(0, n)) AS k FROM (SELECT DISTINCT r, i, n FROM m)) GROUP BY r),
t AS (SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""

def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every vector by six exact rounds, and the error of each and of its label."""
    codes, books = vector_codes.coded(table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_label_errors(codes).withColumn("codebooks_sha256", F.lit(vector_codes.digest(books)))
    return rows.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _op11_sql() -> str:
    nearest = """a{0} AS MATERIALIZED (
  SELECT r, k, min({{'d': d, 'e': e}}) AS m FROM (
    SELECT r, k, e, CAST(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT) AS d FROM p JOIN b{0} USING (k))
  GROUP BY r, k)"""
    moved = """s{0} AS MATERIALIZED (
  SELECT k, e, i, sum(v) AS t, count(*) AS n FROM (SELECT k, m.e AS e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS v FROM a{0} JOIN p USING (r, k)) GROUP BY k, e, i),
b{1} AS MATERIALIZED (
  SELECT k, e, coalesce(f.c, b{0}.c) AS c
  FROM b{0} LEFT JOIN (SELECT k, e, list(CAST((t - ((t % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{0} GROUP BY k, e) f USING (k, e))"""
    rounds = ",\n".join(nearest.format(i) + ",\n" + moved.format(i, i + 1) for i in range(6))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, k, v[k * (len(v) // 8) + 1:(k + 1) * (len(v) // 8)] AS x FROM kept, range(8) t(k)),
b0 AS MATERIALIZED (SELECT k, r - 1 AS e, x AS c FROM p WHERE r <= 16),
{rounds},
{nearest.format(6)},
codes AS (SELECT r, string_agg(printf('%02x', m.e), '' ORDER BY k) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a6 GROUP BY r),
sha AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY k, e)) AS codebooks_sha256 FROM b6)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (r), sha
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all documents with its near words and the form that it is a variant of."""
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS t),
runs AS MATERIALIZED (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, run, count(*) AS c FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')), '{UPPER}', '{LOWER}') AS run FROM documents)
  GROUP BY ALL),
hashed AS MATERIALIZED (
  SELECT run, c, length(run) AS l, xor(list_reduce(list_concat([4294967295],
    list_transform(regexp_extract_all(hex(encode(id || ':' || run)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
    lambda r, b: xor(r >> 8, t[(xor(r, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc),
words AS MATERIALIZED (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT c, CASE WHEN h % 31 = 0 THEN substring(run, 1, h % l) || substring(run, h % l + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
rests AS MATERIALIZED (
  SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS m FROM rests a JOIN rests b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM rests a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM rests a JOIN words b ON a.rest = b.word),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(x.k, 0) AS n_near, CASE WHEN x.m >= 10 * w.n THEN x.other END AS form, CASE WHEN x.m >= 10 * w.n THEN x.m END AS form_n
  FROM words w LEFT JOIN (SELECT word, count(*) AS k, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word) x USING (word)),
way(word, root) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT way.word, formed.form FROM way JOIN formed ON formed.word = way.root WHERE formed.form IS NOT NULL)
SELECT formed.word, formed.form, way.root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN way ON way.word = formed.word JOIN formed final ON final.word = way.root AND final.form IS NULL
"""


def op13_ordered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, in order, cut into sequences of at most 1024 tokens."""
    return ordered_packing.packed(table(spark, sf_dir, "documents"), capacity=1024, ending=0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_language_id": op2_language_id,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_token_counts": op4_token_counts,
    "op5_secret_scans": op5_secret_scans,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_quality_rules": op8_quality_rules,
    "op9_license_scans": op9_license_scans,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_vector_codes": op11_vector_codes,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_ordered_packing": op13_ordered_packing,
}
ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": OP1_SQL,
    "op8_quality_rules": OP8_SQL,
    "op9_license_scans": _op9_sql(),
    "op10_benchmark_decontamination": OP10_SQL,
    "op11_vector_codes": _op11_sql(),
    "op12_spelling_variants": OP12_SQL,
}
