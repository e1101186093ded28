"""The four batch jobs, each a chain of the library's operators over whole archives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import accessions, bychain, delta, exports, quality, scoring
from .operators.entities import preferred


def ranked_hits(hits: DataFrame, info: DataFrame, nodes: DataFrame, xrefs: DataFrame, override: DataFrame | None = None, cutoff: float = scoring.MIN_IDENTITY) -> DataFrame:
    """Hits to ranking: filter, overridden taxa, the three scores and their sum, rank within each entity."""
    if override is not None:
        hits = scoring.with_tax_override(hits, override)
    return scoring.ranked(scoring.score(hits, info, scoring.tax_lineage(nodes), xrefs, cutoff))


def chain_mappings(ranked: DataFrame, chains: DataFrame, records: DataFrame, structure_own: DataFrame, user: DataFrame | None = None) -> DataFrame:
    """(entry, chain, accession) to align: the user's mapping of a chain, else the best hit of its entity that has a living record, else what its file names.

    chains (entry, chain, entity); structure_own (entry, entity, accession); user (entry, chain, accession).
    """
    key = ["entry", "chain", "accession"]
    top = accessions.live(scoring.curated_top(ranked).select("entry", "entity", "accession"), records)
    sources = [top.join(chains, ["entry", "entity"]).select(*key, F.lit(2).alias("priority")), structure_own.join(chains, ["entry", "entity"]).select(*key, F.lit(3).alias("priority"))]
    if user is not None:
        sources.append(user.select(*key, F.lit(1).alias("priority")))
    rows = sources[0]
    for more in sources[1:]:
        rows = rows.unionByName(more)
    return preferred(rows, ["entry", "chain"]).select(*key).distinct()


def mapped_entries(aligned: DataFrame, residue_table: DataFrame | None, chains: DataFrame, records: DataFrame, read: Callable = bychain.listed) -> tuple[DataFrame, DataFrame]:
    """Entries to rows: (segments of 26 columns, residues of 24).

    aligned: one row for each alignment (entry, chain, accession, pdb_at, unp_at, unp_aln, pdb_aln, best,
    canonical); residue_table: see ``assembly.residue_table``, with auth; without it chains have a column residues, of
    which ``read`` makes the rows of a chain; chains: (entry, chain, entity, asym, sequence, chimera, tax_id); records:
    (accession, name, seq_version, sequence, tax_id). What belongs to a chain comes together in one row and is gone
    through there, see ``operators.bychain``; tables that are dealt out by entry before stay where they are.
    """
    own = bychain.gathered(residue_table) if residue_table is not None else None
    seg = bychain.segment_table(bychain.chain_rows(aligned, own, chains, records, letters=False), read)
    res = bychain.residue_table(bychain.chain_rows(aligned, own, chains, records), read)
    return seg, res


def exported(segments: DataFrame, residue_rows: DataFrame, atoms: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables to exports: numbered segments, residue cross-references and atom cross-references.

    The first two are written once to the shared folder, which checks their keys for nulls on the way, and read from there.
    """
    numbered = quality.written_checked(exports.unp_segments(exports.best_segments(segments)), "segments", ["entry", "entity_id", "asym_id", "unp_acc"])
    xrefs = quality.written_checked(exports.xref_db(residue_rows, numbered), "xrefs", ["entry", "entity_id", "asym_id", "seq_id"])
    return numbered, xrefs, exports.atom_site_xref(atoms, xrefs)


def release_changes(old: DataFrame, new: DataFrame, other_old: DataFrame, other_new: DataFrame, databases: list[str] | None = None) -> DataFrame:
    """Exports of two releases to the typed changes between them; equal ones give no rows."""
    return delta.typed_delta(delta.exported_segments(old, other_old), delta.exported_segments(new, other_new), databases)
