"""Structure files, assembled rows, accessions, bonds and gaps on small planted cases."""

import random

import pytest
from pyspark.sql import functions as F

from helixlake import jobs
from helixlake.operators import accessions, assembly, delta, entities, exports, gaps, quality, residues, scoring, search, structure
from helixlake.sources import structures


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


FILE = """data_9XYZ
# invented
_entity_poly.entity_id                      1
_entity_poly.type                           'polypeptide(L)'
_entity_poly.pdbx_seq_one_letter_code
;A(MSE)C
D
;
_entity_poly.pdbx_seq_one_letter_code_can   "AMCD"
_entity_poly.pdbx_strand_id                 A
loop_
_entity_src_gen.entity_id
_entity_src_gen.pdbx_gene_src_ncbi_taxonomy_id
1 4932
#
loop_
_pdbx_poly_seq_scheme.asym_id
_pdbx_poly_seq_scheme.entity_id
_pdbx_poly_seq_scheme.seq_id
_pdbx_poly_seq_scheme.mon_id
_pdbx_poly_seq_scheme.pdb_strand_id
_pdbx_poly_seq_scheme.auth_seq_num
_pdbx_poly_seq_scheme.pdb_ins_code
_pdbx_poly_seq_scheme.hetero
X 1 1 ALA A 11 . n
X 1 2 MSE A 12 . y
X 1 2 SER A 12 . y
X 1 3 CYS A ?  . n
X 1 4 ASP A 14 B n
loop_
_struct_ref_seq_dif.pdbx_pdb_strand_id
_struct_ref_seq_dif.seq_num
_struct_ref_seq_dif.details
_struct_ref_seq_dif.db_mon_id
A 4 'ENGINEERED mutation' GLU
A 1 'expression tag' ?
"""


@pytest.fixture(scope="module")
def parsed(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("files")
    (where / "9XYZ.cif").write_text(FILE)
    (where / "8bad.cif").write_text("data_8BAD\nloop_\n_a.b\n_a.c\n1 2 3\n")
    (where / "list.txt").write_text(f"{where}/9XYZ.cif\n\n  {where}/8bad.cif \n{where}/none.cif\n")
    paths = structures.listed_paths(spark, str(where / "list.txt"))
    there, lacking = structures.present(paths)
    assert there.count() == 2 and rows(lacking) == [(f"{where}/none.cif",)]
    files, missing = structures.read_listed(paths)
    assert files.count() == 2 and rows(missing) == rows(lacking)
    nowhere = structures.present(spark.createDataFrame([(f"{where}/no/folder/x.cif",)], "path string"))
    assert nowhere[0].count() == 0 and nowhere[1].count() == 1
    return structures.categories(files)


def test_structure_files(spark, parsed):
    assert rows(structures.failed(parsed)) == [("8bad", "a loop of a ends within a row")]
    got = structures.scheme_rows(parsed).orderBy("row_no").collect()
    assert [(r.seq_id, r.comp, r.auth_seq_num, r.ins_code) for r in got] == [(1, "ALA", "11", None), (2, "MSE", "12", None), (2, "SER", "12", None), (3, "CYS", None, None), (4, "ASP", "14", "B")]
    poly = structures.entity_rows(parsed).first()
    assert (poly.type, poly.raw, poly.canonical, poly.strands) == ("polypeptide(L)", "A(MSE)C\nD", "AMCD", "A")
    names = structures.entity_rows(parsed).select(F.inline(entities.modified_names(F.col("raw"))))
    assert rows(names) == [("MSE", 2)]


def test_entities_of_a_file(spark, parsed):
    letters = spark.createDataFrame(list(entities.STANDARD.items()), "three string, one string")
    out = assembly.structure_entities(structures.scheme_rows(parsed), structures.entity_rows(parsed), structures.source_taxa(parsed), letters)
    assert rows(out) == [("9xyz", "1", "AXCD", 4932)]
    table = assembly.residue_table(structures.scheme_rows(parsed), structures.annotations(parsed), letters).orderBy("seq_id", "mh_id").collect()
    assert [(r.seq_id, r.mh_id, r.letter, r.rtype, r.original, r.observed) for r in table] == [(1, 1, "A", "Expression tag", None, True), (2, 1, "X", None, None, True), (2, 2, "S", None, None, True), (3, 1, "C", None, None, False), (4, 1, "D", "Engineered mutation", "E", True)]


def test_files_are_read_once_for_all_categories(spark, parsed, tmp_path):
    """The scratch table holds what the files hold, category by category, and a category opens its own folder alone."""
    seen = tmp_path / "seen"
    seen.mkdir()

    def marked(batches):
        for batch in batches:
            for entry in batch.column(0).to_pylist():
                (seen / f"{entry}-{len(list(seen.iterdir()))}").touch()
            yield batch

    text = "data_1\nloop_\n_a.x\n_a.y\n1 ?\n. 'two words'\n_b.x\n;one\n two\n;\n_c.d \"q\" # comment\n#all\nloop_\n_e.f\n_e.g 1\n2 3 4\n"
    files = spark.createDataFrame([("one", text), ("bad", "data_\n1")], "entry string, text string").mapInArrow(marked, "entry string, text string")
    once = structures.parsed(files)
    assert len(list(seen.iterdir())) == 2
    assert rows(structures.category(once, "a", ["x", "y"]), "row_no") == [("one", 1, "1", None), ("one", 2, ".", "two words")]
    assert rows(structures.category(once, "b", ["x"])) == [("one", 1, "one\n two")] and rows(structures.category(once, "c", ["d"])) == [("one", 1, "q")]
    assert rows(structures.category(once, "e", ["f", "g"]), "row_no") == [("one", 1, "1", "2"), ("one", 2, "3", "4")]
    assert rows(structures.failed(once)) == [("bad", "a value without a tag: '1'")]
    assert len(list(seen.iterdir())) == 2
    plan = once.where("category = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in plan


def test_component_dictionary(spark):
    text = "data_ALA\n_chem_comp.id ALA\n_chem_comp.one_letter_code A\nloop_\n_chem_comp_atom.comp_id\n_chem_comp_atom.atom_id\n_chem_comp_atom.type_symbol\n_chem_comp_atom.pdbx_n_terminal_atom_flag\n_chem_comp_atom.pdbx_c_terminal_atom_flag\n_chem_comp_atom.pdbx_ordinal\nALA N N Y N 1\nALA CA C N N 2\nALA C C N Y 3\n"
    files = spark.createDataFrame([("ala", text), ("zzz", "data_ZZZ\n_chem_comp.id ZZZ\n_chem_comp.one_letter_code ?\n"), ("none", None)], "entry string, text string")
    parsed = structures.categories(files)
    assert rows(structures.component_letters(parsed), "three") == [("ALA", "A"), ("ZZZ", "X")]
    assert rows(entities.terminals(structures.component_atoms(parsed))) == [("ALA", "N", 1, "C", 3)]
    assert rows(structures.failed(parsed)) == [("none", "no text")]


def test_repeated_dimension_rows_do_not_multiply_hits(spark):
    hits = spark.createDataFrame([("e", "1", "P", 1.0, 1.0, 0, 10, 5, 5)], "entry string, entity string, accession string, identity double, coverage double, mismatch int, query_len int, query_tax_id int, target_tax_id int")
    info = spark.createDataFrame([("P", "TrEMBL", 1.0), ("P", "Swiss-Prot", 3.0), ("P", None, None)], "accession string, provenance string, annotation_score double")
    xrefs = spark.createDataFrame([("P", 4), ("P", 9)], "accession string, pdb_cross_references long")
    nodes = spark.createDataFrame([(5, 1), (1, None)], "tax_id int, parent int")
    override = spark.createDataFrame([("e", "1", 5), ("e", "1", 1)], "entry string, entity string, tax_id int")
    out = jobs.ranked_hits(hits, info, nodes, xrefs, override).collect()
    assert [(r.query_tax_id, r.dataset_score, r.pdb_cross_references, r.total_score, r.hit_rank) for r in out] == [(5, 60.0, 9, 1260.0, 1)]


def test_lineages_in_a_circle_are_errors(spark):
    with pytest.raises(ValueError):
        scoring.tax_lineage(spark.createDataFrame([(1, 2), (2, 1)], "tax_id int, parent int"), max_depth=5)


def test_identity_is_rounded(spark):
    one = spark.createDataFrame([("ABC", "ABD", 4), ("", "", 0)], "u string, p string, n int")
    assert rows(one.select(residues.identity(F.col("u"), F.col("p")), residues.coverage(F.col("p"), F.col("n")))) == [(0.67, 0.75), (None, 0.0)]


def test_changes_by_segment_or_by_chain(spark):
    schema = "entry string, chain string, db string, accession string, pdb_start int, pdb_end int, unp_start int, unp_end int, row_no int"
    old = [("e", "A", "UNP", "P", 1, 5, 1, 5, 1), ("e", "A", "UNP", "P", 7, 9, 7, 9, 2), ("e", "A", "UNP", "Q", 20, 30, 1, 11, 3), ("e", "B", "UNP", "P", 1, 5, 1, 5, 4), ("e", "B", "UNP", "P", 7, 9, 7, 9, 5), ("e", "A", "Pfam", "F", 1, 2, None, None, 6)]
    new = [("e", "A", "UNP", "Q", 20, 31, 1, 12, 1), ("e", "A", "UNP", "R", 1, 2, 1, 2, 2), ("e", "A", "UNP", "R", 3, 4, 3, 4, 3), ("e", "C", "UNP", "S", 1, 2, 1, 2, 4), ("e", "C", "UNP", "S", 4, 5, 4, 5, 5)]
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    want = [
        ("e", "A", "Pfam", "F", "obsoleted_mapping", "1_2__", None),
        ("e", "A", "UNP", "P", "obsoleted_mapping", "1_5_1_5", None), ("e", "A", "UNP", "P", "obsoleted_mapping", "7_9_7_9", None),
        ("e", "A", "UNP", "Q", "changed_segments", "20_30_1_11", "20_31_1_12"),
        ("e", "A", "UNP", "R", "new_mapping", None, "1_2_1_2"), ("e", "A", "UNP", "R", "new_mapping", None, "3_4_3_4"),
        ("e", "B", "UNP", "P", "obsoleted_mapping", "1_5_1_5;7_9_7_9", None),
        ("e", "C", "UNP", "S", "new_mapping", None, "1_2_1_2;4_5_4_5"),
    ]
    assert sorted(rows(delta.typed_delta(a, b)), key=str) == sorted(want, key=str)
    assert sorted(rows(delta.typed_delta(a, b, ["UNP"])), key=str) == sorted(want[1:], key=str)
    assert delta.typed_delta(a, a).isEmpty()


@pytest.mark.parametrize(
    "ranges,repeated",
    [([("P", 1, 50), ("P", 60, 99)], False), ([("P", 60, 99), ("P", 1, 50)], True), ([("P", 1, 50), ("P", 40, 99)], True), ([("P", 1, 50), ("P", 300, 340)], True), ([("P", 1, 200), ("P", 50, 60)], True), ([("P", 1, 50)], False), ([("P", 1, 50), ("Q", 40, 99)], False)],
)
def test_repeats(spark, ranges, repeated):
    df = spark.createDataFrame([("e", "A", a, s, t, k) for k, (a, s, t) in enumerate(ranges)], "entry string, chain string, accession string, unp_start int, unp_end int, row_no int")
    assert rows(residues.chimera_flags(df)) == [("e", "A", len({a for a, _, _ in ranges}) > 1, repeated)]


def test_chimeras_are_not_merged(spark):
    df = spark.createDataFrame([("A", 1, 5, 1, 5, True, True), ("A", 6, 9, 6, 9, False, True)], "c string, pdb_start int, pdb_end int, unp_start int, unp_end int, bonded_next boolean, chimera boolean")
    assert residues.merge_connected(df, ["c"], apart="chimera").count() == 2 and residues.merge_connected(df, ["c"]).count() == 1


def test_terminal_bonds(spark):
    def residue(k, n, c, **more):
        own = {"observed": True, "ins_code": None, "rtype": None} | more
        return ("e", "A", k, own["observed"], own["ins_code"], own["rtype"]), [("e", "A", k, "ALA", a, x, 0.0, 0.0, i) for i, (a, x) in enumerate((("N", n), ("CA", 50.0), ("C", c))) if x is not None]

    made = [residue(1, 0.0, 1.0), residue(2, 2.42, 3.0), residue(3, 4.44, 5.0), residue(4, 6.0, None), residue(5, 7.0, 8.0), residue(6, 9.0, 10.0, rtype="Linker"), residue(7, 11.0, 12.0), residue(8, 99.0, 12.5), residue(9, 80.0, 99.9)]
    res = spark.createDataFrame([r for r, _ in made], "entry string, asym string, seq_id int, observed boolean, ins_code string, rtype string")
    atoms = spark.createDataFrame([a for _, x in made for a in x], "entry string, asym string, seq_id int, comp_id string, atom_id string, x double, y double, z double, row_no int")
    ends = spark.createDataFrame([("ALA", "N", 1, "C", 3)], "comp_id string, n_atom string, n_ord int, c_atom string, c_ord int")
    spine = structure.backbone(res, atoms, ends)
    got = {r.seq_id: (r.distance, r.bonded) for r in structure.terminal_bonds(spine).collect()}
    # 1.42 holds and 1.44 doesn't; residue 4 lacks its C; 6 is a linker; 8 and 9 are near from N to C
    assert got[1] == (1.42, True) and got[2] == (1.44, False) and got[3] == got[4] == got[5] == got[6] == (None, False) and got[8] == (0.9, True)
    pairs = spark.createDataFrame([("e", "A", 1, 2), ("e", "A", 5, 7)], "entry string, asym string, seq_id int, next_id int")
    assert {r.seq_id: r.bonded for r in structure.bonded_pairs(pairs, spine).collect()} == {1: True, 5: False}


def test_segments_that_meet_an_earlier_one_go(spark):
    df = spark.createDataFrame([("A", 1, 10, 1), ("A", 5, 7, 2), ("A", 11, 20, 3), ("A", 0, 30, 4), ("B", 5, 7, 5)], "chain string, pdb_start int, pdb_end int, n int")
    assert [r.n for r in gaps.without_overlaps(df, ["chain"], ["n"]).orderBy("n").collect()] == [1, 3, 5]


def walked(text, bonds, base, most=10):
    """Gap repair letter by letter, on a list of places instead of a text."""
    for n in range(most):
        text, moves = list(text), []
        letters = [i for i, c in enumerate(text) if c != "-"]
        of = {i: base + k for k, i in enumerate(letters)}
        for left, right in zip(letters, letters[1:], strict=False):
            if right == left + 1:
                continue
            k = of[left]
            bond = lambda i: 0 <= i < len(bonds) and bonds[i] is True
            if k + 1 > len(bonds):
                continue
            alone = left == 0 or text[left - 1] == "-"
            on_left, on_right = not alone and bond(k - 1), bond(k)
            if not on_right:
                continue
            if not on_left:
                moves.append((left, right, 1))
                continue
            lb = next((s for s in range(10) if k - 1 - s - 1 >= 0 and k - 1 - s - 1 < len(bonds) and not bonds[k - 2 - s]), None)
            seen = [s for s in range(10) if k - 2 - s < 0]
            lb = None if lb is not None and seen and lb > seen[0] else lb
            rb = next((s for s in range(10) if k + 1 + s < len(bonds) and not bonds[k + 1 + s]), None)
            if lb is not None and rb is None:
                moves.append((left, right, 2 if lb == 0 else 1))
        moves = [(a, b, k) for a, b, k in moves if k <= b - a - 1]
        if not moves:
            return "".join(text), n
        for a, b, k in moves:
            own = text[a - k + 1 : a + 1]
            text[a - k + 1 : a + 1] = ["-"] * k
            text[b - k : b] = own
        text = "".join(text)
    return text, most


def test_stabilised_gaps_against_a_walk(spark):
    r = random.Random(5)
    cases = []
    for k in range(300):
        text = "".join(r.choice("ABCD---") for _ in range(r.randrange(1, 40)))
        n = len(text.replace("-", "")) + 3
        cases.append((k, text, [r.choice([True, True, True, False, None]) for _ in range(n)], r.randrange(3)))
    df = spark.createDataFrame(cases, "k int, aligned string, bonds array<boolean>, base int")
    got = {x.k: (x.corrected, x.rounds) for x in gaps.stabilise_gaps(df, ["k"]).collect()}
    assert got == {k: walked(t, b, at) for k, t, b, at in cases}
    assert sum(n > 1 for _, n in got.values()) > 5
    assert rows(gaps.stabilise_gaps(spark.createDataFrame([(1, None, None, 0)], "k int, aligned string, bonds array<boolean>, base int"), ["k"])) == [(1, None, 0)]


@pytest.mark.parametrize(
    "text,broken,want",
    [
        ("ABCDEF---GH---IJKLMNO", [], "ABCDEF------GHIJKLMNO"),  # bonded to the right anchor
        ("ABCDEF---GH---IJKLMNO", [7], "ABCDEF---GH---IJKLMNO"),  # not bonded to it
        ("ABCDEF---GH---IJKLMNO", [6], "ABCDEF---G----HIJKLMNO"[:10] + "----HIJKLMNO"[-11:]),  # the bond between the two is broken
        ("AB----CDEFGHIJKL", [], "----ABCDEFGHIJKL"),
        ("AB----CDEFGHIJKL", [0], "AB----CDEFGHIJKL"),
        ("ABCDEFGHIJ---KL", [], "ABCDEFGHIJKL---"),
        ("ABC---DEF", [], "ABC---DEF"),  # too short
        ("ABCDE--FG--HIJK", [], "ABCDE--FG--HIJK"),  # no anchors
    ],
)
def test_refined_gaps(spark, text, broken, want):
    n = len(text.replace("-", ""))
    df = spark.createDataFrame([(1, text, [k not in broken for k in range(n - 1)], 1, n, False), (2, text, [True] * n, 1, n, True)], "k int, aligned string, bonds array<boolean>, start int, stop int, chimera boolean")
    got = dict(rows(gaps.refine_gaps(df, ["k"])))
    assert got == {1: want, 2: text} and len(got[1]) == len(text)


def entry(spark):
    aligned = [("e", "A", "P1", 1, 11, "MKL-TW", "MKIGTW", True, True), ("f", "A", "P1", 1, 1, "MK", "MK", False, False)]
    aligned = spark.createDataFrame(aligned, "entry string, chain string, accession string, pdb_at int, unp_at int, unp_aln string, pdb_aln string, best boolean, canonical boolean")
    table = [("e", "A", k + 1, 1, c * 3, c, None, str(k + 5), "B" if k == 5 else None, k != 4) for k, c in enumerate("MKIGTWY")]
    table += [("f", "A", k + 1, 1, c * 3, c, None, str(k + 1), None, True) for k, c in enumerate("MKA")] + [("g", "A", 1, 1, "MMM", "M", None, "1", None, True)]
    table = spark.createDataFrame(table, "entry string, chain string, seq_id long, mh_id int, comp string, letter string, rtype string, auth string, ins_code string, observed boolean")
    chains = spark.createDataFrame([("e", "A", "1", "X", "MKIGTWY", False, 77), ("f", "A", "1", "X", "MKA", False, None), ("g", "A", "1", "X", "M", False, None)], "entry string, chain string, entity string, asym string, sequence string, chimera boolean, tax_id int")
    records = spark.createDataFrame([("P1", "NAME", 3, "MKAAAAAAAAMKLTW", 9)], "accession string, name string, seq_version int, sequence string, tax_id int")
    return aligned, table, chains, records


def test_mapped_entries(spark):
    seg, res = jobs.mapped_entries(*entry(spark))
    assert seg.columns == [c.split()[0] for c in assembly.SEGMENT.split(",")] and len(seg.columns) == 26
    assert res.columns == [c.split()[0] for c in assembly.RESIDUE.split(",")] and len(res.columns) == 24
    got = {(r.entry_id, r.reference_acc, r.id): r for r in seg.collect()}
    a = got["e", "P1", 1]
    assert (a.accession, a.name, a.seq_version, a.unp_start, a.unp_end, a.pdb_start, a.pdb_end, a.auth_start, a.auth_end, a.unp_alignment, a.pdb_alignment, a.conflicts) == ("P1", "NAME", 3, 11, 13, 1, 3, 5, 7, "MKL", "MKI", 1)
    assert (a.identity, a.score, a.best_mapping, a.canonical_acc, a.chimera) == (0.67, 0.67, True, True, False)
    assert (got["e", "P1", 2].pdb_start, got["e", "P1", 2].auth_end_icode, got["e", "P1", 2].unp_alignment) == (5, "B", "TW")
    assert [(got["e", "P1", k].pdb_start, got["e", "P1", k].pdb_end, got["e", "P1", k].accession) for k in (3, 4)] == [(4, 4, None), (7, 7, None)]
    whole = got["f", None, 1]  # no canonical accession of the chain is mapped
    assert (whole.pdb_start, whole.pdb_end, whole.best_mapping, whole.canonical_acc, whole.pdb_alignment) == (1, 3, False, True, "MKA")
    assert got["g", None, 1].best_mapping and quality.without_canonical(seg.select(F.col("entry_id").alias("entry"), F.col("auth_asym_id").alias("chain"), "canonical_acc")).isEmpty()
    by = {(r.entry_id, r.pdb_seq_id): r for r in res.collect()}
    assert (by["e", 3].type, by["e", 3].unp_one_letter_code, by["e", 3].unp_seq_id, by["e", 3].tax_id, by["e", 3].best_mapping) == ("Conflict", "L", 13, 77, True)
    assert (by["e", 4].accession, by["e", 4].reference_acc, by["e", 4].tax_id, by["e", 5].observed, by["e", 6].auth_seq_id_ins_code) == (None, "P1", None, "N", "B")
    assert (by["g", 1].canonical_acc, by["g", 1].reference_acc, by["f", 1].tax_id, by["e", 1].residue_id) == (True, None, 9, "e_1_X_1")


def test_exports_and_changes(spark):
    seg, res = jobs.mapped_entries(*entry(spark))
    atoms = spark.createDataFrame([("e", "1", "X", 1, 100, 1), ("e", "1", "X", 4, 101, 2)], "entry string, entity_id string, asym_id string, seq_id int, id int, pdbx_label_index int")
    numbered, xrefs, placed = jobs.exported(seg, res, atoms)
    assert numbered.columns == ["entry", *exports.UNP_SEGMENTS] and len(exports.UNP_SEGMENTS) == 11
    assert rows(numbered.select("segment_id", "instance_id", "unp_start", "seq_id_end", "best_mapping"), "segment_id") == [(1, 1, 11, 3, "y"), (2, 1, 14, 6, "y")]
    assert len(xrefs.columns) == 20 and rows(xrefs.select("seq_id", "unp_segment_id", "res_type", "observed"), "seq_id") == [(1, 1, None, "y"), (2, 1, None, "y"), (3, 1, "Conflict", "y"), (5, 2, None, "n"), (6, 2, None, "y")]
    assert rows(placed, "id") == [("e", 100, 1, "UNP", "P1", 11, "M"), ("e", 101, 2, None, None, None, None)]
    other = spark.createDataFrame([], exports.XREF_DB_SEGMENTS)
    changed = jobs.release_changes(numbered, numbered.where("segment_id = 1"), other, other)
    assert rows(changed.select("delta_type", "old_segments", "new_segments")) == [("changed_segments", "1_3_11_13;5_6_14_15", "1_3_11_13")]
    assert jobs.release_changes(numbered, numbered, other, other).isEmpty()


def test_chain_mappings_go_by_precedence(spark):
    ranked = spark.createDataFrame([("e", "1", "P", 5.0, 1, 1.0, 1.0), ("f", "1", "Q", 5.0, 1, 1.0, 1.0)], "entry string, entity string, accession string, total_score double, pdb_cross_references int, adjusted_score double, dataset_score double")
    chains = spark.createDataFrame([("e", "A", "1"), ("e", "B", "1"), ("f", "A", "1")], "entry string, chain string, entity string")
    records = spark.createDataFrame([("P", "MK"), ("Q", "")], "accession string, sequence string")
    own = spark.createDataFrame([("e", "1", "X"), ("f", "1", "Y")], "entry string, entity string, accession string")
    user = spark.createDataFrame([("e", "B", "U")], "entry string, chain string, accession string")
    assert rows(jobs.chain_mappings(ranked, chains, records, own, user), "entry", "chain") == [("e", "A", "P"), ("e", "B", "U"), ("f", "A", "Y")]


def test_long_letters_and_precedence_of_alignments(spark):
    res = spark.createDataFrame([("c", 1, "M"), ("c", 2, "TYG"), ("c", 3, "K")], "chain string, seq_id int, letters string")
    mapped = spark.createDataFrame([("c", k, 10 + k) for k in range(1, 6)], "chain string, pdb_pos long, unp_pos long")
    assert rows(residues.with_long_letters(mapped, res, ["chain"]), "unp_pos") == [("c", 1, 11), ("c", 2, 12), ("c", 2, 13), ("c", 2, 14), ("c", 3, 15)]
    two = spark.createDataFrame([("c", 1, 5, 2), ("c", 1, 9, 1), ("c", 2, 6, 2)], "chain string, pdb_pos long, unp_pos long, rank int")
    assert rows(residues.preferred_positions(two, ["chain"]), "pdb_pos") == [("c", 1, 9), ("c", 2, 6)]


def test_folded_islands_are_those_of_positions(spark):
    r = random.Random(4)
    made = [(k, "".join(r.choice("AB-") for _ in range(r.randrange(30))), "".join(r.choice("AB-") for _ in range(r.randrange(30))), r.randrange(1, 9), r.randrange(1, 9)) for k in range(200)] + [(900, None, "A", 1, 1), (901, "ABC" * 4000, "AB-" * 4000, 1, 1)]
    df = spark.createDataFrame(made, "aln long, unp_aln string, pdb_aln string, unp_start int, pdb_start int")
    key = ["aln", "pdb_start", "pdb_end", "unp_start", "unp_end"]
    assert rows(residues.aligned_islands(df).select(*key), "aln", "pdb_start") == rows(residues.islands(residues.residue_map(df), ["aln"]).select(*key), "aln", "pdb_start")


def test_modes_of_isoforms(spark):
    chains = spark.createDataFrame([("e", "A", "P", False), ("e", "B", "Q", True)], "entry string, chain string, accession string, chimera boolean")
    iso = spark.createDataFrame([("P", "P"), ("P", "P-2"), ("P", "Z-1"), ("Q", "Q-2")], "accession string, isoform string")
    found = lambda mode: rows(accessions.isoform_candidates(chains, iso, iso.where("isoform = 'P-2'"), mode).select("accession", "isoform"), "isoform")
    assert found("isoform") == [("P", "P"), ("P", "P-2"), ("Q", "Q")] and found("representative") == [("P", "P-2"), ("Q", "Q")]
    with pytest.raises(ValueError):
        found("other")


def test_diagonal_alignment(spark, tmp_path):
    q = spark.createDataFrame([("a", "XXMKTAYIAKQRZZ"), ("b", "MKTAY")], "query string, sequence string")
    r = spark.createDataFrame([("t", "GGGMKTAYIAKQRGG"), ("s", "AMKTAYXXXX")], "ref string, sequence string")
    c = spark.createDataFrame([("a", "t", 1), ("b", "s", 1), ("b", "t", 99)], "query string, ref string, diagonal long")
    got = {x["query"]: x for x in search.diagonal_align(c, q, r).collect()}
    a, b = got["a"], got["b"]
    assert (a.qstart, a.qend, a.tstart, a.tend, a.mismatch, a.identity, a.qaln, a.taln) == (3, 12, 4, 13, 0, 1.0, "MKTAYIAKQR", "MKTAYIAKQR")
    assert (b.qlen, b.alnlen, b.coverage) == (10, 9, 0.9)  # filled up with X to ten letters, of which four meet


def test_schemes(spark):
    canonical = spark.createDataFrame([("e", "1", k + 1, c) for k, c in enumerate(("ALA", "CYS", "ASP"))], "entry string, entity string, seq_id long, mon_id string")
    chains = spark.createDataFrame([("e", "1", "A", "X", 1), ("e", "1", "B", "Y", 2)], "entry string, entity string, chain string, asym string, row_no int")
    mapped = spark.createDataFrame([("e", "A", 1, 2), ("e", "A", 2, 3)], "entry string, chain string, pdb_pos long, unp_pos long")
    seen = spark.createDataFrame([("e", "A", 1, 52, "CYX", ".", "n"), ("e", "A", 2, 53, "ASP", ".", "y"), ("e", "B", 2, 63, "ASP", ".", "n")], "entry string, chain string, pdb_pos long, auth_seq_id int, comp string, ins_code string, hetero string")
    full = entities.rebuilt_scheme(canonical, chains, mapped, seen)
    assert full.columns == ["entry", *entities.SCHEME]
    assert rows(full.where("pdb_strand_id = 'A'").select("seq_id", "pdb_seq_num", "auth_mon_id", "hetero"), "seq_id") == [("1", "?", "ALA", "n"), ("2", "52", "CYX", "n"), ("3", "53", "ASP", "y")]
    short = entities.updated_scheme(canonical, chains, mapped, seen)
    assert short.columns == ["entry", *entities.SCHEME]
    assert rows(short.select("asym_id", "seq_id", "auth_seq_num", "pdb_mon_id"), "asym_id", "seq_id") == [("X", "1", ".", "."), ("X", "2", "52", "CYS"), ("X", "3", "53", "ASP"), ("Y", "1", ".", "."), ("Y", "2", ".", "."), ("Y", "3", "63", "ASP")]
    atoms = spark.createDataFrame([("e", "X", "1", 52, "CYX", 1), ("e", "X", "1", 52, "CYX", 2), ("e", "X", "1", 53, "ASP", 3), ("e", "X", "1", 54, "HOH", 4)], "entry string, asym string, entity string, auth_seq_id int, comp_id string, row_no int")
    shared = spark.createDataFrame([("e", "1", 1, 2), ("e", "1", 2, 3)], "entry string, entity string, pdb_pos long, seq_id long")
    assert [r.label_seq_id for r in entities.relabelled_atoms(atoms, shared).orderBy("row_no").collect()] == ["2", "2", "3", "."]
