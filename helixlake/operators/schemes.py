"""Residue schemes of whole chains: a chain's sequence, alignment and coordinates lie in one row and are gone through there.

The rules are those of :func:`entities.rebuilt_scheme`, :func:`entities.updated_scheme` and
:func:`entities.poly_seq_scheme`, which join rows of single residues.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

COORDINATES = ["pdb_pos", "auth_seq_id", "comp", "ins_code", "hetero"]
FLUSH = 1000  # chains that a task holds before it passes them on


def placed(unp: str | None, pdb: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(pdb_pos, unp_pos) of the columns with a letter on both sides, from 1 on."""
    if unp is None or pdb is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = min(len(unp), len(pdb))
    u, p = (np.frombuffer(x[:n].encode("utf-32-le", "surrogatepass"), np.uint32) != 45 for x in (unp, pdb))
    take = np.flatnonzero(u & p)
    return np.cumsum(p)[take], np.cumsum(u)[take]


def monomers(own: dict) -> pa.Array:
    """The names that a row's ``sequence`` lists."""
    return pa.array(own["sequence"] or [], pa.string())


def coordinates(own: dict) -> dict[str, pa.Array]:
    """A row's ``coordinates``, a list of COORDINATES, as columns."""
    rows = sorted(own["coordinates"] or [], key=lambda x: x["pdb_pos"])
    kinds = {"pdb_pos": pa.int64()}
    return {c: pa.array([None if x[c] is None or c in kinds else str(x[c]) for x in rows] if c not in kinds else [x[c] for x in rows], kinds.get(c, pa.string())) for c in COORDINATES}


class Scheme:
    """One chain: the names of its canonical sequence and, of each place of it, the coordinate residue aligned to it."""

    def __init__(self, own: dict, names: pa.Array, seen: dict[str, pa.Array]):
        self.own, self.names, self.seen = own, names, seen
        p, u = placed(own["unp_aln"], own["pdb_aln"])
        at, n = seen["pdb_pos"].to_numpy(zero_copy_only=False), len(names)
        place = np.searchsorted(at, p)
        found = (place < len(at)) & (np.append(at, 0)[np.minimum(place, len(at))] == p) & (u <= n)
        index = np.full(n, -1, np.int64)
        index[u[found] - 1] = place[found]
        self.index = pa.array(np.maximum(index, 0), mask=index < 0)

    def __len__(self) -> int:
        return len(self.names)

    def column(self, name: str, otherwise: str | pa.Array | None = None) -> pa.Array:
        """A column of the coordinates at each place of the sequence, and what stands where there is none."""
        own = self.seen[name].take(self.index) if len(self.seen[name]) else pa.nulls(len(self), pa.string())
        return own if otherwise is None else pc.coalesce(own, otherwise)

    def rebuilt(self) -> dict[str, pa.Array]:
        """pdb_seq_num and auth_mon_id; what was not seen is '?', its name the canonical one."""
        return {"pdb_seq_num": self.column("auth_seq_id", "?"), "auth_mon_id": self.column("comp", self.names), "mon_id": self.names}

    def updated(self) -> dict[str, pa.Array]:
        """auth_seq_num and pdb_mon_id; what was not seen is '.'."""
        auth = self.column("auth_seq_id")
        return {"auth_seq_num": pc.coalesce(auth, "."), "pdb_mon_id": pc.if_else(auth.is_null(), ".", self.names), "mon_id": self.names}


def joined(column: pa.Array, by: str = "") -> str:
    """The values of a column as one text, nulls left out."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column.cast(pa.string())), by)[0].as_py() if not column.null_count else by.join(x for x in column.to_pylist() if x is not None)


def entry_rows(canonical: DataFrame, chains: DataFrame, aligned: DataFrame, seen: DataFrame) -> DataFrame:
    """One row for each entry: lists of its sequences, chains, alignments and coordinates.

    canonical (entry, entity, sequence); chains (entry, entity, chain, asym, row_no); aligned (entry, chain, unp_aln,
    pdb_aln), one of a chain; seen (entry, chain, coordinates). All are joined by entry alone, so tables that are dealt
    out by it before stay where they are.
    """
    listed = lambda rows, name, *columns: rows.groupBy("entry").agg(F.collect_list(F.struct(*columns)).alias(name))
    rows = listed(canonical, "sequences", "entity", "sequence").join(listed(chains, "chains", "entity", "chain", "asym", "row_no"), "entry")
    return rows.join(listed(aligned, "aligned", "chain", "unp_aln", "pdb_aln"), "entry", "left").join(listed(seen, "seen", "chain", "coordinates"), "entry", "left")


def chains_of(row: dict, shared: bool = False) -> Iterator[dict]:
    """Of a row of :func:`entry_rows` one dict for each chain of each sequence: entry, entity, chain, asym, sequence, unp_aln, pdb_aln, coordinates.

    With ``shared`` the alignment of an entity's first chain (row_no) serves all its chains.
    """
    pairs, seen = ({x["chain"]: x for x in row[c] or []} for c in ("aligned", "seen"))
    for s in row["sequences"]:
        own = [c for c in row["chains"] if c["entity"] == s["entity"]]
        first = min((c for c in own if c["row_no"] is not None), key=lambda c: c["row_no"], default={"chain": None})["chain"]
        for c in own:
            pair = pairs.get(first if shared else c["chain"], {})
            yield {"entry": row["entry"], **c, **s, "unp_aln": pair.get("unp_aln"), "pdb_aln": pair.get("pdb_aln"), "coordinates": seen.get(c["chain"], {}).get("coordinates")}


def each_scheme(
    rows: DataFrame, work: Callable[[Scheme], Iterator[pa.RecordBatch] | tuple], made: str, names: Callable[[dict], pa.Array] = monomers, seen: Callable[[dict], dict[str, pa.Array]] = coordinates,
    each: Callable[[dict], Iterator[dict] | list[dict]] = chains_of,
) -> DataFrame:
    """What ``work`` makes of every scheme: one tuple of the columns ``made``, or batches of them. each: the chains of a row; names and seen: what a chain's sequence and coordinates say."""
    arrow = to_arrow_schema(StructType.fromDDL(made))

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            for k in range(b.num_rows):
                for own in each({c: x[k].as_py() for c, x in zip(b.schema.names, b.columns, strict=True)}):
                    found = work(Scheme(own, names(own), seen(own)))
                    if not isinstance(found, tuple):
                        yield from found
                        continue
                    held.append(found)
                if len(held) >= FLUSH:
                    yield batch(held)
                    held = []
        if held:
            yield batch(held)

    return rows.mapInArrow(run, made)
