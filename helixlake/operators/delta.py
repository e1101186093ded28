"""Snapshots: what changed between two releases."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Labels of changes.
OBSOLETED, NEW, CHANGED = "obsoleted_mapping", "new_mapping", "changed_segments"
CHAIN = ["entry", "chain"]


def _key(rows: DataFrame) -> list[str]:
    return [*CHAIN, *(["db"] if "db" in rows.columns else []), "accession"]


def segment_lists(segments: DataFrame) -> DataFrame:
    """The segments of each mapping as a list of strings, in the order of rows; a missing reference range is empty."""
    text = F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("pdb_start", "pdb_end", "unp_start", "unp_end")])
    rows = F.sort_array(F.collect_list(F.struct("row_no", text.alias("s"))))
    return segments.groupBy(*_key(segments)).agg(F.transform(rows, lambda x: x.s).alias("segments"))


def typed_delta(old: DataFrame, new: DataFrame, databases: list[str] | None = None) -> DataFrame:
    """What became of each mapping (entry, chain, db if there is one, accession) that differs.

    Where a whole chain comes or goes, each of its mappings is one row, segments joined by ';'. Where a chain
    stays and a mapping comes or goes, each segment is a row. A mapping that stays with other segments is one row
    with both joined. ``databases``: of chains that stay only these.
    """
    key, chain = _key(new), Window.partitionBy(*CHAIN)
    a, b = segment_lists(old).withColumnRenamed("segments", "o"), segment_lists(new).withColumnRenamed("segments", "n")
    both = a.join(b, key, "full_outer")
    stays = F.max(F.col("o").isNotNull()).over(chain) & F.max(F.col("n").isNotNull()).over(chain)
    both = both.withColumn("stays", stays)
    if databases is not None and "db" in key:
        both = both.where(~F.col("stays") | F.col("db").isin(*databases))
    kind = F.when(F.col("n").isNull(), OBSOLETED).when(F.col("o").isNull(), NEW).when(F.col("o") != F.col("n"), CHANGED)
    joined = lambda c: F.array_join(c, ";")
    one = F.coalesce("o", "n")
    pieces = F.when(F.col("delta_type") == CHANGED, F.array(F.lit(None).cast("string"))).when(F.col("stays"), one).otherwise(F.array(joined(one)))
    rows = both.withColumn("delta_type", kind).where("delta_type IS NOT NULL").select(*key, "delta_type", "o", "n", F.explode(pieces).alias("s"))
    is_ = lambda k: F.col("delta_type") == k
    return rows.select(*key, "delta_type", F.when(is_(CHANGED), joined("o")).when(is_(OBSOLETED), F.col("s")).alias("old_segments"), F.when(is_(CHANGED), joined("n")).when(is_(NEW), F.col("s")).alias("new_segments"))


def exported_segments(unp: DataFrame, other: DataFrame) -> DataFrame:
    """Rows to compare, read back from the two exported segment tables: those of the reference database, with its label, and all others.

    Other databases have no reference range; it is empty.
    """
    own = unp.select("entry", F.col("asym_id").alias("chain"), F.lit("UNP").alias("db"), F.col("unp_acc").alias("accession"), F.col("seq_id_start").cast("long").alias("pdb_start"), F.col("seq_id_end").cast("long").alias("pdb_end"), F.col("unp_start").cast("long").alias("unp_start"), F.col("unp_end").cast("long").alias("unp_end"), F.struct("segment_id", "instance_id", "seq_id_start", "seq_id_end").alias("row_no"))
    none = F.lit(None).cast("long")
    more = other.select("entry", F.col("asym_id").alias("chain"), F.col("xref_db").alias("db"), F.col("xref_db_acc").alias("accession"), F.col("seq_id_start").cast("long").alias("pdb_start"), F.col("seq_id_end").cast("long").alias("pdb_end"), none.alias("unp_start"), none.alias("unp_end"), F.struct("segment_id", "instance_id", "seq_id_start", "seq_id_end").alias("row_no"))
    return own.unionByName(more)


MARKS = "n long, low decimal(38,0), high decimal(38,0)"


def fingerprints(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, n, low, high): how many rows each key has, and two sums of their hashes, whatever their order.

    Multisets of rows that differ have different fingerprints but for a chance of about 2^-100. Columns count by
    name. A null is told from any value. Without keys one row for all. Parts of a key add up before the shuffle.
    """
    cols = sorted(rows.columns)
    whole = [*cols, *[F.col(c).isNull() for c in cols]]  # a hash passes over nulls, so where they are is hashed, too
    sums = [F.coalesce(F.sum(F.xxhash64(*seed, *whole).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)") for seed in ([], [F.lit("high")])]
    return rows.groupBy(*(keys or [])).agg(F.count(F.lit(1)).alias("n"), sums[0].alias("low"), sums[1].alias("high"))


def changed_keys(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose fingerprints (keys, n, low, high) are not the same in both, with n_old and n_new, 0 where a key is missing."""
    a, b = old.select(*keys, F.struct("n", "low", "high").alias("__o")), new.select(*keys, F.struct("n", "low", "high").alias("__n"))
    both = a.join(b, keys, "full_outer").where("NOT (__o <=> __n)")
    return both.select(*keys, F.coalesce("__o.n", F.lit(0)).alias("n_old"), F.coalesce("__n.n", F.lit(0)).alias("n_new"))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether both hold the same rows, each as often: one pass over either, by their fingerprints."""
    return sorted(a.columns) == sorted(b.columns) and fingerprints(a).first() == fingerprints(b).first()


def first_difference(new: DataFrame, old: DataFrame, levels: list[tuple[str, str]]) -> DataFrame:
    """For each new row the first level, of (column, label), whose prefix of columns the old rows lack."""
    out, cols = new, []
    label = F.lit(None).cast("string")
    for k, (column, _) in enumerate(levels):
        cols.append(column)
        out = out.join(old.select(*cols).distinct().withColumn(f"__has{k}", F.lit(True)), list(cols), "left")
    for k, (_, name) in reversed(list(enumerate(levels))):
        label = F.when(F.col(f"__has{k}").isNull(), F.lit(name)).otherwise(label)
    return out.withColumn("difference", label).drop(*[f"__has{k}" for k in range(len(levels))])


def newest_releases(rows: DataFrame, keep: int = 10, date: str = "release_date") -> DataFrame:
    """Rows of the newest releases: distinct dates are ranked, not rows."""
    dates = rows.select(date).distinct().withColumn("__r", F.dense_rank().over(Window.orderBy(F.desc(date)))).where(f"__r <= {keep}")
    return rows.join(dates.select(date), date, "left_semi")


def changed_databases(delta: DataFrame) -> DataFrame:
    return delta.groupBy("entry").agg(F.array_join(F.array_sort(F.collect_set("db")), ",").alias("databases"))


def release_gate(revisions: DataFrame, used: list[str], now: str) -> DataFrame:
    """(entry, skip): there is a revision to come, and none of those to come touches a used category."""
    future = F.col("revision_date") > F.lit(now).cast("timestamp_ntz")
    out = revisions.groupBy("entry").agg(F.bool_or(future).alias("future"), F.bool_or(future & F.col("category").isin(*used)).alias("touched"), F.count("category").alias("n"))
    return out.select("entry", (F.col("future") & (F.col("n") > 0) & ~F.col("touched")).alias("skip"))
