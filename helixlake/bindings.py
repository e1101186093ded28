"""Registered queries: operators applied to the given tables, each with its SQL twin.

The tables hold no proteins, so each query first renames them to what its operator reads: line items stand
for search hits and segments, documents for sequences and alignments, embeddings for atoms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import delta, exports, quality, residues, scoring, search, structure

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- hits ---------------------------------------------------------------------------------------------------


def hits(spark: SparkSession, d: str) -> DataFrame:
    line, orders = table(spark, d, "lineitem"), table(spark, d, "orders").select("o_orderkey", "o_custkey")
    sup, cus = table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), table(spark, d, "customer").select("c_custkey", "c_nationkey")
    rows = line.join(sup, F.col("l_suppkey") == F.col("s_suppkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(cus, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        F.concat(F.lit("e"), "l_suppkey").alias("entry"), F.col("l_linenumber").alias("entity"), F.concat(F.lit("P"), "l_partkey").alias("accession"), (F.lit(1.0) - F.col("l_discount")).alias("identity"),
        (F.col("l_quantity") / 50).alias("coverage"), F.round(F.col("l_tax") * 100).cast("int").alias("mismatch"), (F.col("l_quantity").cast("int") * 10).alias("query_len"),
        (F.lit(1000) + F.col("s_nationkey")).alias("query_tax_id"), (F.lit(1000) + F.col("c_nationkey")).alias("target_tax_id"), F.col("l_orderkey").alias("hit_id"),
    )


def info(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(
        F.concat(F.lit("P"), "p_partkey").alias("accession"), F.when(F.col("p_brand").like("Brand#1%"), "Swiss-Prot").otherwise("TrEMBL").alias("provenance"), F.when(F.col("p_size") % 7 != 0, F.col("p_size") % 5 + 1).cast("double").alias("annotation_score")
    )


def nodes(spark: SparkSession, d: str) -> DataFrame:
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    return (
        n.select((F.col("n_nationkey") + 1000).alias("tax_id"), (F.col("n_regionkey") + 100).alias("parent"))
        .union(r.select(F.col("r_regionkey") + 100, F.lit(1)))
        .union(spark.sql("SELECT 1 AS tax_id, CAST(NULL AS INT) AS parent"))
    )


def xrefs(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    lists = own.groupBy("l_partkey").agg(F.concat_ws(";", F.collect_list(F.col("l_suppkey").cast("string"))).alias("pdb"))
    return scoring.xref_counts(lists.select(F.concat(F.lit("P"), "l_partkey").alias("accession"), "pdb"))


H = """hits AS (SELECT 'e' || l_suppkey AS entry, l_linenumber AS entity, 'P' || l_partkey AS accession, 1.0::DOUBLE - l_discount AS identity, l_quantity / 50 AS coverage,
  round(l_tax * 100)::INT AS mismatch, l_quantity::INT * 10 AS query_len, 1000 + s_nationkey AS query_tax_id, 1000 + c_nationkey AS target_tax_id, l_orderkey AS hit_id
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
info AS (SELECT 'P' || p_partkey AS accession, CASE WHEN p_brand LIKE 'Brand#1%' THEN 'Swiss-Prot' ELSE 'TrEMBL' END AS provenance, CASE WHEN p_size % 7 <> 0 THEN (p_size % 5 + 1)::DOUBLE END AS annotation_score FROM part),
xrefs AS (SELECT 'P' || l_partkey AS accession, count(DISTINCT l_suppkey) AS pdb_cross_references FROM lineitem GROUP BY l_partkey),
region_of AS (SELECT n_nationkey + 1000 AS tax_id, n_regionkey AS r FROM nation),
scored AS (SELECT h.*, coalesce(identity * coverage * (1.0::DOUBLE - mismatch::DOUBLE / nullif(query_len, 0)::DOUBLE) * 1000, 0.0) AS adjusted_score,
  CASE WHEN query_tax_id = target_tax_id THEN 200.0 WHEN q.r = t.r THEN 50.0 ELSE 25.0 END::DOUBLE AS tax_score,
  CASE WHEN annotation_score IS NULL THEN 0.0 WHEN provenance = 'Swiss-Prot' THEN 20 * annotation_score ELSE 10 * annotation_score - 50 END::DOUBLE AS dataset_score, pdb_cross_references
  FROM hits h JOIN region_of q ON query_tax_id = q.tax_id JOIN region_of t ON target_tax_id = t.tax_id LEFT JOIN info USING (accession) LEFT JOIN xrefs USING (accession) WHERE identity >= 0.9),
full_ AS (SELECT *, adjusted_score + tax_score + dataset_score AS total_score FROM scored)"""
SCORES = ["entry", "entity", "accession", "hit_id", "adjusted_score", "tax_score", "dataset_score", "pdb_cross_references", "total_score"]


def scored(spark: SparkSession, d: str) -> DataFrame:
    return scoring.score(hits(spark, d), info(spark, d), scoring.tax_lineage(nodes(spark, d)), xrefs(spark, d))


@query(f"WITH {H} SELECT entry, entity, accession, hit_id, identity FROM hits WHERE identity >= 0.9")
def c1_identity_filter(spark, d):
    return scoring.identity_filter(hits(spark, d)).select("entry", "entity", "accession", "hit_id", "identity")


@query(f"WITH {H} SELECT {', '.join(SCORES)} FROM full_")
def i36_total_score(spark, d):
    return scored(spark, d).select(*SCORES)


@query(f"WITH {H} SELECT {', '.join(SCORES)}, dense_rank() OVER (PARTITION BY entry, entity ORDER BY total_score DESC NULLS LAST, pdb_cross_references DESC NULLS LAST) AS hit_rank FROM full_")
def f1_ranked_hits(spark, d):
    return scoring.ranked(scored(spark, d)).select(*SCORES, F.col("hit_rank").cast("long").alias("hit_rank"))


@query(f"""WITH {H} SELECT entry, entity, accession, total_score FROM (SELECT *, row_number() OVER (PARTITION BY entry, entity ORDER BY total_score DESC NULLS LAST,
  pdb_cross_references DESC NULLS LAST, adjusted_score DESC NULLS LAST, dataset_score DESC NULLS LAST, accession) AS n FROM full_) WHERE n = 1""")  # fmt: skip
def f2_curated_top(spark, d):
    return scoring.curated_top(scored(spark, d)).select("entry", "entity", "accession", "total_score")


@query(f"WITH {H} SELECT entry, entity, accession, hit_id, total_score FROM (SELECT *, dense_rank() OVER (PARTITION BY entry, entity ORDER BY total_score DESC NULLS LAST, pdb_cross_references DESC NULLS LAST) AS r FROM full_) WHERE r = 1")
def c5_best_hits(spark, d):
    return scoring.ranked(scored(spark, d)).where("hit_rank = 1").select("entry", "entity", "accession", "hit_id", "total_score")


@query("""WITH RECURSIVE n AS (SELECT n_nationkey + 1000 AS tax_id, n_regionkey + 100 AS parent FROM nation UNION ALL SELECT r_regionkey + 100, 1 FROM region UNION ALL SELECT 1, NULL),
l AS (SELECT tax_id, tax_id AS ancestor, 0 AS depth FROM n UNION ALL SELECT l.tax_id, n.parent, depth + 1 FROM l JOIN n ON n.tax_id = l.ancestor WHERE n.parent IS NOT NULL)
SELECT tax_id::BIGINT AS tax_id, ancestor::BIGINT AS ancestor, depth::BIGINT AS depth FROM l""")  # fmt: skip
def i1_tax_lineage(spark, d):
    return scoring.tax_lineage(nodes(spark, d)).select(*[F.col(c).cast("long").alias(c) for c in ("tax_id", "ancestor", "depth")])


@query(f"WITH {H} SELECT DISTINCT query_tax_id::BIGINT AS query_tax_id, target_tax_id::BIGINT AS target_tax_id, CASE WHEN query_tax_id = target_tax_id THEN 200.0 WHEN q.r = t.r THEN 50.0 ELSE 25.0 END::DOUBLE AS tax_score FROM hits JOIN region_of q ON query_tax_id = q.tax_id JOIN region_of t ON target_tax_id = t.tax_id")
def i2_tax_score(spark, d):
    out = scoring.tax_score(scoring.tax_pairs(hits(spark, d)), scoring.tax_lineage(nodes(spark, d)))
    return out.select(F.col("query_tax_id").cast("long").alias("query_tax_id"), F.col("target_tax_id").cast("long").alias("target_tax_id"), "tax_score")


@query("SELECT 'P' || l_partkey AS accession, count(DISTINCT l_suppkey) AS pdb_cross_references FROM lineitem GROUP BY l_partkey")
def a5_xref_counts(spark, d):
    return xrefs(spark, d)


@query(f"WITH {H} SELECT DISTINCT accession FROM hits WHERE accession NOT IN (SELECT 'P' || p_partkey FROM part WHERE p_partkey % 3 = 0)")
def d5_missing_accessions(spark, d):
    known = table(spark, d, "part").where("p_partkey % 3 = 0").select(F.concat(F.lit("P"), "p_partkey").alias("accession"))
    return scoring.missing_accessions(hits(spark, d), known)


@query(f"WITH {H}, o AS (SELECT DISTINCT entry, entity FROM hits WHERE entity = 2) SELECT entry, entity, hit_id, CASE WHEN o.entry IS NULL THEN query_tax_id ELSE 9606 END::BIGINT AS query_tax_id FROM hits LEFT JOIN o USING (entry, entity)")
def d4_tax_override(spark, d):
    h = hits(spark, d)
    override = h.where("entity = 2").select("entry", "entity", F.lit(9606).alias("tax_id")).distinct()
    return scoring.with_tax_override(h, override).select("entry", "entity", "hit_id", F.col("query_tax_id").cast("long").alias("query_tax_id"))


# -- alignments and sequences -------------------------------------------------------------------------------


def alignments(spark: SparkSession, d: str) -> DataFrame:
    x = F.regexp_replace(F.lower("text"), "[^a-z]", "")
    return table(spark, d, "documents").select(F.col("doc_id").alias("aln"), x.alias("x")).select("aln", F.translate("x", "zk", "--").alias("unp_aln"), F.translate("x", "aeq", "-x-").alias("pdb_aln"), "x")


A = """a AS (SELECT doc_id AS aln, regexp_replace(lower(text), '[^a-z]', '', 'g') AS x FROM documents),
aln AS (SELECT aln, x, translate(x, 'zk', '--') AS u, translate(x, 'aeq', '-x-') AS p FROM a),
c AS (SELECT aln, unnest(range(1, length(x) + 1)) AS i, unnest(string_split(u, '')) AS u, unnest(string_split(p, '')) AS p FROM aln WHERE x <> ''),
w AS (SELECT *, sum((u <> '-')::INT) OVER k::BIGINT AS unp_pos, sum((p <> '-')::INT) OVER k::BIGINT AS pdb_pos FROM c WINDOW k AS (PARTITION BY aln ORDER BY i)),
m AS (SELECT aln, pdb_pos, unp_pos FROM w WHERE u <> '-' AND p <> '-')"""


@query(f"WITH {A} SELECT aln, pdb_pos::BIGINT AS pdb_pos, unp_pos::BIGINT AS unp_pos FROM m")
def i5_residue_map(spark, d):
    return residues.residue_map(alignments(spark, d))


@query(f"""WITH {A}, r AS (SELECT *, pdb_pos - row_number() OVER (PARTITION BY aln ORDER BY pdb_pos) AS g FROM m)
SELECT aln, min(pdb_pos)::BIGINT AS pdb_start, max(pdb_pos)::BIGINT AS pdb_end, min(unp_pos)::BIGINT AS unp_start, max(unp_pos)::BIGINT AS unp_end FROM r GROUP BY aln, g""")  # fmt: skip
def i6_islands(spark, d):
    return residues.aligned_islands(alignments(spark, d))


@query(f"""WITH {A}, n AS (SELECT aln, unnest(range(1, length(x) + 1))::BIGINT AS pos FROM aln), l AS (SELECT * FROM n ANTI JOIN m ON m.aln = n.aln AND m.pdb_pos = n.pos),
r AS (SELECT *, pos - row_number() OVER (PARTITION BY aln ORDER BY pos) AS g FROM l) SELECT aln, min(pos) AS pdb_start, max(pos) AS pdb_end FROM r GROUP BY aln, g""")  # fmt: skip
def h7_blank_segments(spark, d):
    a = alignments(spark, d)
    return residues.blanks(a.where("x <> ''").select("aln", F.length("x").alias("length")), residues.aligned_islands(a), ["aln"])


@query(f"""WITH {A} SELECT aln.aln, coalesce(k.m, 0)::BIGINT AS matches, (length(x) - coalesce(k.m, 0))::BIGINT AS conflicts, floor(coalesce(k.m, 0)::DOUBLE / length(x) * 100 + 0.5) / 100 AS identity,
  floor(length(replace(p, '-', ''))::DOUBLE / length(x) * 100 + 0.5) / 100 AS coverage FROM aln LEFT JOIN (SELECT aln, count(*) AS m FROM c WHERE u = p GROUP BY aln) k USING (aln) WHERE length(x) > 0""")  # fmt: skip
def e9_identity(spark, d):
    a = alignments(spark, d).where("x <> ''")
    u, p = F.col("unp_aln"), F.col("pdb_aln")
    return a.select("aln", residues.matches(u, p).cast("long").alias("matches"), residues.conflicts(u, p).cast("long").alias("conflicts"), residues.identity(u, p).alias("identity"), residues.coverage(p, F.length("x")).alias("coverage"))


@query(f"""WITH {A}, s AS (SELECT *, max(CASE WHEN p <> '-' THEN i END) OVER (PARTITION BY aln) AS last FROM w WHERE pdb_pos BETWEEN 10 AND 40)
SELECT aln.aln, coalesce(string_agg(s.p, '' ORDER BY i), '') AS pdb_chunk, coalesce(string_agg(s.u, '' ORDER BY i), '') AS unp_chunk FROM aln LEFT JOIN s ON s.aln = aln.aln AND i <= last WHERE x <> '' GROUP BY aln.aln""")  # fmt: skip
def i16_align_chunk(spark, d):
    return residues.align_chunk(alignments(spark, d).where("x <> ''").select("aln", "unp_aln", "pdb_aln", F.lit(10).alias("start"), F.lit(40).alias("stop")))


@query()
def e3_sequence_assembly(spark, d):
    """Sequences put together from residues; inserted ones become J, changed ones X."""
    docs = table(spark, d, "documents").select("doc_id", F.regexp_replace(F.lower("text"), "[^a-z]", "").alias("t")).where("t <> ''").repartition("doc_id")  # whole texts are dealt out, their letters stay
    rows = docs.select("doc_id", F.posexplode(F.split("t", "")).alias("pos", "letter")).where("letter <> ''")
    kind = F.when(F.col("pos") % 11 == 0, "Insertion").when(F.col("pos") % 13 == 0, "Conflict")
    rows = rows.select("doc_id", "pos", F.lit(0).alias("row_no"), "letter", kind.alias("rtype"), F.lit(None).cast("string").alias("original"))
    return residues.assembled(rows.withColumn("letter", residues.alignment_letter()), ["doc_id"])


SQL["e3_sequence_assembly"] = """WITH t AS (SELECT doc_id, regexp_replace(lower(text), '[^a-z]', '', 'g') AS t FROM documents), p AS (SELECT doc_id, t, unnest(range(0, length(t))) AS i FROM t)
SELECT doc_id, string_agg(CASE WHEN i % 11 = 0 THEN 'J' WHEN i % 13 = 0 THEN 'X' ELSE t[i + 1] END, '' ORDER BY i) AS sequence FROM p GROUP BY doc_id"""


@query("""WITH c AS (SELECT DISTINCT l_orderkey AS chain, l_linenumber AS pos, l_returnflag AS detail FROM lineitem), f AS (
  SELECT *, CASE WHEN detail IS NOT DISTINCT FROM lag(detail) OVER k AND pos = lag(pos) OVER k + 1 THEN 0 ELSE 1 END AS n FROM c WINDOW k AS (PARTITION BY chain ORDER BY pos, detail)),
r AS (SELECT *, sum(n) OVER (PARTITION BY chain ORDER BY pos, detail ROWS UNBOUNDED PRECEDING) AS g FROM f)
SELECT chain, min(detail) AS detail, min(pos)::BIGINT AS "start", max(pos)::BIGINT AS "end" FROM r GROUP BY chain, g""")  # fmt: skip
def i22_difference_runs(spark, d):
    c = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("chain"), F.col("l_linenumber").cast("long").alias("pos"), F.col("l_returnflag").alias("detail"))
    return residues.difference_runs(c, ["chain"])


@query("SELECT doc_id, left(t, 4) || 'AB' || substring(t, 8) AS sequence FROM (SELECT doc_id, left(text, 19) || 'C' || substring(text, 23) AS t FROM documents)")
def i19_splice_variants(spark, d):
    variants = F.array(*[F.struct(F.lit(b).alias("begin"), F.lit(e).alias("end"), F.lit(v).alias("variation")) for b, e, v in ((5, 7, "AB"), (20, 22, "C"))])
    return table(spark, d, "documents").select("doc_id", residues.splice(F.col("text"), variants).alias("sequence"))


# -- atoms --------------------------------------------------------------------------------------------------


def atoms(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("embedding")
    return table(spark, d, "embeddings").select(F.col("label").alias("chain"), "vec_id", *[e[i].cast("double").alias(c) for i, c in enumerate("xyz")])


B = """a AS (SELECT label AS chain, vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
n AS (SELECT *, lead(vec_id) OVER k AS next_order, lead(x) OVER k AS x2, lead(y) OVER k AS y2, lead(z) OVER k AS z2 FROM a WINDOW k AS (PARTITION BY chain ORDER BY vec_id)),
b AS (SELECT chain, vec_id, next_order, floor(sqrt((x - x2) * (x - x2) + (y - y2) * (y - y2) + (z - z2) * (z - z2)) * 100) / 100 AS distance FROM n WHERE next_order IS NOT NULL)"""
LIMIT = 0.25


@query(f"WITH {B} SELECT chain, vec_id, next_order, distance, distance <= {LIMIT} AS bonded FROM b")
def i10_bond_table(spark, d):
    return structure.bond_table(atoms(spark, d), ["chain"], "vec_id", LIMIT)


@query(f"""WITH {B}, f AS (SELECT *, coalesce(lag(distance <= {LIMIT}) OVER (PARTITION BY chain ORDER BY vec_id), false) AND chain % 3 <> 0 AS j FROM b),
r AS (SELECT *, sum((NOT j)::INT) OVER (PARTITION BY chain ORDER BY vec_id) AS g FROM f)
SELECT chain, min(vec_id) AS pdb_start, max(next_order) AS pdb_end, min(vec_id) AS unp_start, max(next_order) AS unp_end FROM r GROUP BY chain, g""")  # fmt: skip
def i9_merge_connected(spark, d):
    """Every third chain stands for a chimera, which keeps its segments."""
    b = structure.bond_table(atoms(spark, d), ["chain"], "vec_id", LIMIT)
    rows = b.select("chain", F.col("vec_id").alias("pdb_start"), F.col("next_order").alias("pdb_end"), F.col("vec_id").alias("unp_start"), F.col("next_order").alias("unp_end"), F.col("bonded").alias("bonded_next"), (F.col("chain") % 3 == 0).alias("chimera"))
    return residues.merge_connected(rows, ["chain"], apart="chimera")


@query(f"WITH {B} SELECT chain, vec_id, min(CASE WHEN distance > {LIMIT} THEN vec_id END) OVER (PARTITION BY chain ORDER BY vec_id ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS first_break FROM b")
def f12_look_ahead(spark, d):
    return structure.look_ahead(structure.bond_table(atoms(spark, d), ["chain"], "vec_id", LIMIT), ["chain"], "vec_id").select("chain", "vec_id", "first_break")


# -- segments -----------------------------------------------------------------------------------------------


def segments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("entity"), (F.col("l_partkey") % 5).alias("accession"), F.col("l_quantity").cast("long").alias("start"), (F.col("l_quantity").cast("long") + F.col("l_linenumber")).alias("end"), "l_orderkey", "l_linenumber"
    )


S = """s AS (SELECT l_suppkey AS entity, l_partkey % 5 AS accession, l_quantity::BIGINT AS "start", l_quantity::BIGINT + l_linenumber AS "end", l_orderkey, l_linenumber FROM lineitem),
n AS (SELECT *, count(*) OVER k AS n, min((l_orderkey, l_linenumber, "start", "end")) OVER k AS f FROM s WINDOW k AS (PARTITION BY entity, accession, "start", "end")),
num AS (SELECT entity, accession, "start", "end", l_orderkey, l_linenumber, (1 + coalesce(sum((n = 1)::INT) OVER k, 0))::BIGINT AS segment_id, (1 + coalesce(sum((n > 1)::INT) OVER k, 0))::BIGINT AS instance_id FROM n
  WINDOW k AS (PARTITION BY entity, accession ORDER BY f, l_orderkey, l_linenumber, "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (SELECT entity, accession, segment_id, instance_id, unnest(range("start", "end" + 1)) AS seq_id FROM num)"""


def numbered(spark: SparkSession, d: str) -> DataFrame:
    return exports.number_segments(segments(spark, d), ["entity", "accession"], ["l_orderkey", "l_linenumber", "start", "end"])


@query(f'WITH {S} SELECT entity, accession, "start", "end", l_orderkey, l_linenumber, segment_id, instance_id FROM num')
def i12_number_segments(spark, d):
    return numbered(spark, d)


@query(f"WITH {S} SELECT entity, accession, seq_id, count(*) AS n, max(segment_id) AS last_segment FROM e GROUP BY ALL")
def d14_segment_expansion(spark, d):
    spread = exports.expand(numbered(spark, d), ["entity", "accession"], ["segment_id", "instance_id"])
    return spread.groupBy("entity", "accession", "seq_id").agg(F.count(F.lit(1)).alias("n"), F.max("segment_id").alias("last_segment"))


@query(f"WITH {S} SELECT entity, seq_id, CASE WHEN count(DISTINCT accession) = 1 THEN min(accession) END AS accession FROM e GROUP BY ALL")
def e8_unambiguous_xref(spark, d):
    spread = exports.expand(numbered(spark, d), ["entity", "accession"], [])
    return exports.unambiguous(spread, ["entity", "seq_id"], ["accession"])


@query(f"""WITH {S}, r AS (SELECT DISTINCT entity, accession, seq_id FROM e), l AS (SELECT entity, accession, seq_id, max((segment_id, instance_id)) AS s FROM e GROUP BY ALL)
SELECT entity, seq_id, accession, s[1] AS segment_id, s[2] AS instance_id, CASE WHEN seq_id % 7 = entity % 7 THEN 'n' ELSE 'y' END AS observed, row_number() OVER (PARTITION BY entity, seq_id ORDER BY accession) AS ordinal FROM l""")  # fmt: skip
def i13_residue_xrefs(spark, d):
    n = numbered(spark, d)
    rows = exports.expand(n, ["entity", "accession"], []).distinct()
    seen = rows.select("entity", "seq_id").distinct().withColumn("auth_seq_num", F.when(F.col("seq_id") % 7 != F.col("entity") % 7, F.col("seq_id")))
    return exports.residue_xrefs(rows, n, seen, ["entity"]).withColumn("ordinal", F.col("ordinal").cast("long"))


# -- snapshots ----------------------------------------------------------------------------------------------


def snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    q = F.col("l_quantity").cast("long")
    rows = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("entry"), (F.col("l_orderkey") % 3 * 10 + F.col("l_linenumber")).alias("chain"), F.concat(F.lit("D"), F.col("l_linenumber") % 2).alias("db"), (F.col("l_partkey") % 5).alias("accession"), "l_partkey", "l_orderkey",
        q.alias("pdb_start"), (q + 9).alias("pdb_end"), q.alias("unp_start"), (q + 9).alias("unp_end"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_no"),
    )
    new = rows.where("l_orderkey % 7 <> 2 AND entry % 11 <> chain % 11").withColumn("pdb_end", F.when(F.col("l_partkey") % 7 == 0, F.col("pdb_end") + 1).otherwise(F.col("pdb_end")))
    return rows.where("l_orderkey % 5 <> 1 AND entry % 7 <> chain % 7"), new


D = """o AS (SELECT l_suppkey AS entry, l_orderkey % 3 * 10 + l_linenumber AS chain, 'D' || l_linenumber % 2 AS db, l_partkey % 5 AS accession, l_quantity::BIGINT AS q, l_orderkey * 10 + l_linenumber AS n, l_partkey AS p, l_orderkey AS k FROM lineitem),
x AS (SELECT entry, chain, db, accession, list(concat_ws('_', q, q + 9, q, q + 9) ORDER BY n, concat_ws('_', q, q + 9, q, q + 9)) AS o FROM o WHERE k % 5 <> 1 AND entry % 7 <> chain % 7 GROUP BY ALL),
y AS (SELECT entry, chain, db, accession, list(concat_ws('_', q, q + 9 + (p % 7 = 0)::INT, q, q + 9) ORDER BY n, concat_ws('_', q, q + 9 + (p % 7 = 0)::INT, q, q + 9)) AS n FROM o WHERE k % 7 <> 2 AND entry % 11 <> chain % 11 GROUP BY ALL),
j AS (SELECT *, bool_or(o IS NOT NULL) OVER c AND bool_or(n IS NOT NULL) OVER c AS stays FROM x FULL JOIN y USING (entry, chain, db, accession) WINDOW c AS (PARTITION BY entry, chain)),
t AS (SELECT entry, chain, db, accession, 'changed_segments' AS delta_type, array_to_string(o, ';') AS old_segments, array_to_string(n, ';') AS new_segments FROM j WHERE o <> n
  UNION ALL SELECT entry, chain, db, accession, 'obsoleted_mapping', unnest(CASE WHEN stays THEN o ELSE [array_to_string(o, ';')] END), NULL FROM j WHERE n IS NULL
  UNION ALL SELECT entry, chain, db, accession, 'new_mapping', NULL, unnest(CASE WHEN stays THEN n ELSE [array_to_string(n, ';')] END) FROM j WHERE o IS NULL)"""


@query(f"WITH {D} SELECT * FROM t")
def h4_typed_delta(spark, d):
    return delta.typed_delta(*snapshots(spark, d))


@query(f"WITH {D} SELECT entry, string_agg(DISTINCT db, ',' ORDER BY db) AS databases FROM t GROUP BY entry")
def e14_changed_databases(spark, d):
    return delta.changed_databases(delta.typed_delta(*snapshots(spark, d)))


@query("""WITH o AS (SELECT l_suppkey AS entry, l_linenumber AS chain, l_quantity::BIGINT AS pdb_start, l_orderkey AS k, l_partkey AS p FROM lineitem),
a AS (SELECT * FROM o WHERE entry % 5 <> 1 AND p % 3 <> 0), b AS (SELECT DISTINCT entry, chain, pdb_start FROM o WHERE k % 7 <> 2)
SELECT entry, chain, pdb_start, CASE WHEN entry NOT IN (SELECT entry FROM a) THEN 'New mapped pdb entry' WHEN (entry, chain) NOT IN (SELECT (entry, chain) FROM a) THEN 'New mapped struct_asym_id'
  WHEN (entry, chain, pdb_start) NOT IN (SELECT (entry, chain, pdb_start) FROM a) THEN 'New mapped pdb_start' END AS difference FROM b""")  # fmt: skip
def h5_first_difference(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("entry"), F.col("l_linenumber").alias("chain"), F.col("l_quantity").cast("long").alias("pdb_start"), "l_orderkey", "l_partkey")
    new = rows.where("l_orderkey % 7 <> 2").select("entry", "chain", "pdb_start").distinct()
    levels = [("entry", "New mapped pdb entry"), ("chain", "New mapped struct_asym_id"), ("pdb_start", "New mapped pdb_start")]
    return delta.first_difference(new, rows.where("entry % 5 <> 1 AND l_partkey % 3 <> 0"), levels)


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS release_date FROM orders WHERE o_orderdate::DATE IN (SELECT DISTINCT o_orderdate::DATE FROM orders ORDER BY 1 DESC LIMIT 10)")
def b13_newest_releases(spark, d):
    return delta.newest_releases(table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date")))


@query("""SELECT o_custkey AS entry, bool_or(o_orderdate > TIMESTAMP '1997-06-01') AND NOT bool_or(o_orderdate > TIMESTAMP '1997-06-01' AND o_orderpriority IN ('1-URGENT', '2-HIGH')) AS skip FROM orders GROUP BY o_custkey""")
def c10_release_gate(spark, d):
    rev = table(spark, d, "orders").select(F.col("o_custkey").alias("entry"), F.col("o_orderdate").alias("revision_date"), F.col("o_orderpriority").alias("category"))
    return delta.release_gate(rev, ["1-URGENT", "2-HIGH"], "1997-06-01")


# -- search and checks --------------------------------------------------------------------------------------


@query("""WITH q AS (SELECT item_id AS query, i AS qpos, substring(text, i, 24) AS k FROM (SELECT item_id, text, unnest(range(1, length(text) - 22)) AS i FROM benchmark WHERE length(text) >= 24)),
r AS (SELECT doc_id AS ref, i AS rpos, substring(text, i, 24) AS k FROM (SELECT doc_id, text, unnest(range(1, length(text) - 22)) AS i FROM documents WHERE length(text) >= 24))
SELECT query, ref, (rpos - qpos)::BIGINT AS diagonal, count(*) AS shared, min(qpos)::BIGINT AS qstart, max(qpos)::BIGINT AS qlast FROM q JOIN r USING (k) GROUP BY ALL HAVING count(*) >= 2""")  # fmt: skip
def i3_kmer_candidates(spark, d):
    q = table(spark, d, "benchmark").select(F.col("item_id").alias("query"), F.col("text").alias("sequence"))
    r = table(spark, d, "documents").select(F.col("doc_id").alias("ref"), F.col("text").alias("sequence"))
    return search.candidates(q, r, k=24)


@query("SELECT page_id, regexp_full_match(u, '[a-zA-Z0-9][a-zA-Z0-9_-]{0,63}') AS valid FROM (SELECT page_id, split_part(url, '/', -1) AS u FROM pages)")
def c12_valid_entry(spark, d):
    return table(spark, d, "pages").select("page_id", quality.valid_entry(F.split_part("url", F.lit("/"), F.lit(-1))).alias("valid"))


@query("SELECT 'lang' AS \"column\", count(*) FILTER (lang IS NULL) AS nulls FROM documents UNION ALL SELECT 'source', count(*) FILTER (source IS NULL) FROM documents UNION ALL SELECT 'text', count(*) FILTER (text IS NULL) FROM documents")
def m5_null_counts(spark, d):
    return quality.null_counts(table(spark, d, "documents"), ["lang", "source", "text"])


@query("""WITH m AS (SELECT l_orderkey AS entry, l_linenumber % 3 AS chain, l_linenumber % 3 + (l_orderkey % 4 = 0)::INT * (l_linenumber % 2) AS accession, l_linenumber * 40 + (l_quantity::BIGINT % 7) * 20 AS s, l_linenumber AS n, l_partkey AS p FROM lineitem),
r AS (SELECT *, s + 9 + p % 30 AS e, row_number() OVER (PARTITION BY entry, chain ORDER BY n, p, s) AS i FROM m), g AS (
SELECT a.entry, a.chain, bool_or(b.s <= a.s OR b.s <= a.e OR (a.i = 1 AND b.i = 2 AND b.s - a.e - 1 > 3 * ((b.e - b.s + 1) / 2 - 5))) AS bad FROM r a JOIN r b ON a.entry = b.entry AND a.chain = b.chain AND a.i < b.i GROUP BY ALL)
SELECT entry, chain, count(DISTINCT accession) > 1 AS chimera, coalesce(any_value(bad), false) AND count(DISTINCT accession) = 1 AS repeated FROM r LEFT JOIN g USING (entry, chain) GROUP BY entry, chain""")  # fmt: skip
def i7_chimera_flags(spark, d):
    line, start = F.col("l_linenumber"), F.col("l_linenumber") * 40 + (F.col("l_quantity").cast("long") % 7) * 20
    m = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("entry"), (line % 3).alias("chain"), (line % 3 + F.when(F.col("l_orderkey") % 4 == 0, line % 2).otherwise(0)).alias("accession"),
        start.alias("unp_start"), (start + 9 + F.col("l_partkey") % 30).alias("unp_end"), F.struct(line, "l_partkey", start).alias("row_no"),
    )
    return residues.chimera_flags(m)
