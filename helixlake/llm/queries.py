"""One registered query for each training-data operator, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, collocations, langid, licenses, line_dedup, merkle, mixing, ngram_join, packing, quality_cnn, rules, toxicity_cnn
from .common import WORD, fold

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def learnable(documents: DataFrame) -> DataFrame:
    """The documents that labels may be learned from."""
    return documents.where(fold("doc_id", 5) != 0)


def _scored(documents: DataFrame, scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *[c for c in scores.columns if c not in ("doc_id", "score")])


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality_cnn.fit(learnable(documents), table(spark, sf_dir, "labels"))
    return _scored(documents, quality_cnn.scores(documents, model), quality_cnn.THRESHOLD)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity_cnn.fit(learnable(documents), table(spark, sf_dir, "labels"))
    return _scored(documents, toxicity_cnn.scores(documents, model), 0.5)


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), templates=licenses.TEMPLATES)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.verdicts(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.split("text", "\n", -1)).alias("n_lines"))
    left = line_dedup.dedup(documents)
    return left.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.char_length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    profiles = langid.fit(documents.where(fold("doc_id", 4) != 2))
    found = langid.predict(documents, profiles)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, and the root that each row's proof gives for what the row holds now; every seventh row's n_chars has been tampered with."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.leaf([F.col("n_chars") + 1 if c == "n_chars" else c for c in fields]))
    found = merkle.manifest(table(spark, sf_dir, "documents"), "lang", "doc_id", fields, {"now": tampered})
    found = found.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof("path"), 256).alias("proof_sha256"), merkle.folded(F.coalesce("now", "leaf"), "path").alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), "lang")


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_ngram_jaccard_join, op3_toxicity, op4_license_scans, op5_quality_rules, op6_source_mixing, op7_nearest_neighbours, op8_line_dedup, op9_language_id, op10_bpe, op11_best_fit_packing, op12_merkle_manifest, op13_phrase_collocations)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TEMPLATES = ", ".join(f"('{k}', '{s}')" for k, t in licenses.TEMPLATES.items() for s in licenses.shingles_of(t))

SQL = {
    "op2_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) m ON m.a = d.doc_id""",
    "op4_license_scans": f"""
WITH t(license, s) AS (VALUES {_TEMPLATES}), w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w
), f AS (SELECT doc_id, license, count(*) AS n FROM s JOIN t USING (s) GROUP BY ALL), n AS (SELECT license, count(*) AS n FROM t GROUP BY license)
SELECT doc_id, license, n.n::BIGINT AS n_template, f.n::BIGINT AS n_found FROM f JOIN n USING (license) WHERE 100 * f.n >= 80 * n.n""",
    "op5_quality_rules": f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM documents
), g AS (
  SELECT doc_id, list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) AS g FROM w
), u AS (
  SELECT doc_id, unnest(g) AS g, generate_subscripts(g, 1) AS i FROM g
), r AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM u) WHERE c > 1) GROUP BY doc_id
), s AS (
  SELECT doc_id, t, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)
), v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 30 * n_words OR word_chars < 2 * n_words OR word_chars > 14 * n_words OR 100 * n_dup_lines > 50 * n_lines
    OR 100 * len(regexp_extract_all(t, '[A-Z]')) > 40 * word_chars OR 100 * len(regexp_extract_all(t, '!')) > 50 * n_words OR 400 * len(regexp_extract_all(t, '[.!?:;,]')) < n_words) AS kept
FROM v""",
    "op8_line_dedup": f"""
WITH RECURSIVE l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents
), d AS (
  SELECT line, min((doc_id, i)) AS first FROM l WHERE regexp_matches(line, '{WORD}') GROUP BY line
), p AS (
  SELECT DISTINCT line, length(line) AS n, 0 AS z FROM d WHERE length(line) >= 20
), e AS (
  SELECT x.line AS a, y.line AS b FROM p x JOIN p y ON y.n BETWEEN x.n - 2 AND x.n + 2 AND x.line <> y.line
  WHERE levenshtein(translate(x.line, 'éèêëàâäáçîïíôöóùûüúñßÉÈÊËÀÂÄÁÇÎÏÍÔÖÓÙÛÜÚÑ', '0123456789@$^~`{{}}[];:?=+*&_<>|/QWZYKJXUVGBM'), translate(y.line, 'éèêëàâäáçîïíôöóùûüúñßÉÈÊËÀÂÄÁÇÎÏÍÔÖÓÙÛÜÚÑ', '0123456789@$^~`{{}}[];:?=+*&_<>|/QWZYKJXUVGBM')) <= 2
), r(a, b) AS (SELECT line, line FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
), k AS (SELECT r.a AS line, min(d.first) AS kept FROM r JOIN d ON d.line = r.b GROUP BY r.a)
SELECT d.doc_id, len(string_split(d.text, chr(10)))::BIGINT AS n_lines, length(coalesce(t.text, ''))::BIGINT AS n_chars_left, sha256(coalesce(t.text, '')) AS text_sha256
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM l LEFT JOIN k USING (line) WHERE kept IS NULL OR kept = (doc_id, i) GROUP BY doc_id) t USING (doc_id)""",
    "op12_merkle_manifest": """
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), d AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos, n_chars, text,
    concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-')) AS head, coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 7 = 0 AS tampered FROM documents, t
), f AS (
  SELECT doc_id, lang, pos, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN tampered THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS now FROM d
), n(lang, lev, idx, h, n) AS (
  SELECT lang, 0, pos, leaf, count(*) OVER (PARTITION BY lang) FROM f
  UNION ALL SELECT lang, lev + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2 FROM n WHERE n > 1 GROUP BY lang, lev, idx // 2
), s AS (SELECT lang, h, lev AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM n WHERE n = 1), m(lev, idx, h, n) AS (
  SELECT 0, place, h, count(*) OVER () FROM s UNION ALL SELECT lev + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2 FROM m WHERE n > 1 GROUP BY lev, idx // 2
), r AS (SELECT h AS root, lev AS height FROM m WHERE n = 1), u AS (
  SELECT lang, lev, idx, h FROM n WHERE n > 1 UNION ALL SELECT lang, height + lev, idx, m.h FROM s, m WHERE m.n > 1
), g AS (
  SELECT doc_id, f.lang, leaf, coalesce(now, leaf) AS now, s.h AS subroot, root, unnest(range(s.height + r.height)) AS lev, CASE WHEN lev < s.height THEN pos >> lev ELSE place >> (lev - s.height) END AS x
  FROM f JOIN s ON s.lang IS NOT DISTINCT FROM f.lang, r
), e AS (
  SELECT doc_id, leaf, now, subroot, root, list(CASE WHEN x % 2 = 1 THEN 'l' ELSE 'r' END || coalesce(h, '') ORDER BY g.lev) AS steps
  FROM g LEFT JOIN u ON u.lang IS NOT DISTINCT FROM g.lang AND u.lev = g.lev AND u.idx = xor(x, 1) GROUP BY ALL
), o AS (
  SELECT *, list_reduce([now] || steps, lambda d, s: CASE WHEN s[1] = 'l' THEN sha256(s[2:] || d) ELSE sha256(d || s[2:]) END) AS folded_root FROM e
)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_transform(steps, lambda s: s[2:]), 'string_agg', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM o""",
    "op13_phrase_collocations": f"""
WITH RECURSIVE p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents
), w AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM p
), n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang), f AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g FROM w, unnest([1, 2, 3, 4]) AS t(k)
), c AS (SELECT lang, g, count(*) AS a FROM f GROUP BY lang, g HAVING count(*) >= 30), s AS (
  SELECT c.lang, c.g, c.a, k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a // (x.a + y.a))::BIGINT AS score
  FROM c, unnest(range(1, len(c.g))) AS t(k) JOIN c x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN c y ON y.lang = c.lang AND y.g = c.g[k + 1:]
), b AS (SELECT lang, g, a, arg_min((l, r, score), (score, k)) AS b FROM s GROUP BY ALL), d AS (
  SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM c z WHERE z.lang = b.lang AND len(z.g) > len(b.g) AND 100 * z.a >= 80 * b.a
    AND (z.g[1:len(b.g)] = b.g OR z.g[2:len(b.g) + 1] = b.g OR z.g[3:len(b.g) + 2] = b.g))
), o AS (SELECT lang, array_to_string(g, ' ') AS phrase, a::BIGINT AS a, b[1]::BIGINT AS l, b[2]::BIGINT AS r, b[3] AS score FROM d)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o) JOIN n USING (lang) WHERE rank <= 2000""",
}
