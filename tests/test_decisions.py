import random

import pytest
from pyspark.sql import functions as F

from helixlake.operators import accessions, decisions, scoring
from helixlake.sources import records_xml


def test_continuity_against_a_walk(spark):
    r = random.Random(4)
    chains = {c: [r.choice([False, False, False, True, None]) for _ in range(n)] for c, n in (("A", 1), ("B", 30), ("C", 12))}
    df = spark.createDataFrame([(c, i, b) for c, bs in chains.items() for i, b in enumerate(bs)], "chain string, i int, broken boolean")
    for row in decisions.continuity(df, ["chain"], ["i"]).collect():
        bonds = [b is not False for b in chains[row.chain][:-1]]
        right = next((k for k in range(10) if row.i + k < len(bonds) and bonds[row.i + k]), None)
        left = next((k for k in range(10) if row.i - 1 - k >= 0 and bonds[row.i - 1 - k]), None)
        assert (row.left_break, row.right_break) == (left, right)


def test_gap_actions(spark):
    cases = [
        (True, False, 0, None, True, "ok", 0), (False, True, None, None, True, "fix", 1), (None, True, None, None, False, "fix", 1), (False, None, 1, 1, True, "chain_break", 0),
        (True, True, None, 3, True, "ok", 0), (True, True, 0, None, True, "fix", 2), (True, True, 2, None, True, "fix_partial", 1), (True, True, None, None, True, "ambiguous", 0), (True, True, 1, 1, True, "ambiguous", 0),
    ]
    df = spark.createDataFrame(cases, "l boolean, r boolean, lb int, rb int, p boolean, want string, n int")
    got = df.withColumn("got", decisions.gap_action(*map(F.col, ("l", "r", "lb", "rb", "p")))).withColumn("moved", decisions.letters_to_move(F.col("got"), F.col("l")))
    assert got.where("got <> want OR moved <> n").count() == 0 and got.count() == len(cases)


def test_record_xml(spark, tmp_path):
    (tmp_path / "r.xml").write_text("""<?xml version="1.0"?><records xmlns="http://example.org/records">
<entry dataset="Swiss-Prot" created="1990-01-01" modified="2020-02-02" version="7"><accession>P1</accession><accession>Q2</accession><name>X_HUMAN</name>
<organism><dbReference type="NCBI Taxonomy" id="9606"/></organism><dbReference type="PDB" id="1ABC"/><keyword id="K1">Membrane</keyword>
<feature type="chain" id="F1"><location><begin position="2"/><end position="6"/></location></feature>
<feature type="sequence variant" id="V1"><original>A</original><variation>G</variation><location><position position="3"/></location></feature>
<sequence length="6" mass="700" checksum="AB" modified="1991-01-01" version="2">MKA
LLV</sequence></entry>
<entry dataset="TrEMBL" created="1990-01-01" modified="2020-02-02" version="1"><accession>P9</accession></entry></records>""")
    got = records_xml.read_records(spark, str(tmp_path / "r.xml")).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.accession, row.secondary_accessions, row.sequence, row.seq_length, row.tax_ids, row.keywords) == ("P1", ["Q2"], "MKALLV", 6, [9606], ["MEMBRANE"])
    assert [(f.type, f.begin, f.end, f.variation) for f in row.features] == [("chain", 2, 6, None), ("sequence variant", 3, 3, "G")]
    assert [(x.database, x.id) for x in row.references] == [("PDB", "1ABC")]


def test_records_end_in_isoforms(spark, tmp_path):
    (tmp_path / "r.xml").write_text("""<?xml version="1.0"?><records xmlns="http://example.org/records">
<entry dataset="Swiss-Prot"><accession>P1</accession><name>X</name>
<comment type="function"><text evidence="1 2">Does things.</text><text>More.</text></comment><comment type="online information"><link uri="http://example.org"/></comment>
<comment type="subcellular location"><subcellularLocation><location evidence="2">Membrane</location></subcellularLocation></comment>
<comment type="alternative products"><event type="x"/><isoform><id>P1-1</id><id>P1-9</id><name>1</name><sequence type="displayed"/></isoform>
<isoform><id>P1-2</id><name>Long</name><name>B</name><sequence type="described" ref="V2 V1"/></isoform><isoform><id>P1-3</id><sequence type="described" ref="V1 V7 V8"/></isoform>
<isoform><id>Q5-1</id><sequence type="external"/></isoform></comment>
<feature type="splice variant" id="V1" evidence="1"><original>KA</original><variation>XYZ</variation><location><begin position="2"/><end position="3"/></location></feature>
<feature type="splice variant" id="V2"><location><begin position="5"/><end position="6"/></location></feature>
<feature type="splice variant" id="V8"><location><begin status="unknown"/><end position="6"/></location></feature>
<feature type="signal peptide"><location><begin position="1"/><end position="4" status="unknown"/></location></feature>
<evidence key="1" type="ECO:1"/><evidence key="2" type="ECO:2" category="c" attribute="a" date="2001-01-01"/>
<sequence length="6">MKALLV</sequence></entry>
<entry dataset="TrEMBL"><accession>P2</accession><sequence length="3">AC
D</sequence></entry>
<entry dataset="TrEMBL"><accession>P3</accession><feature type="chain"><location><position position="many"/></location></feature><sequence length="x">AAA</sequence></entry></records>""")
    records = records_xml.read_records(spark, str(tmp_path / "r.xml"))
    row = records.where("accession = 'P1'").first()
    assert [tuple(c) for c in row.comments] == [("function", "Does things.", "1 2"), ("online information", "http://example.org", None), ("subcellular location", "Membrane", "2")]
    assert [(i.isoform, i.names, i.kind, i.variants) for i in row.isoforms] == [("P1-1", ["1"], "displayed", []), ("P1-2", ["Long", "B"], "described", ["V2", "V1"]), ("P1-3", [], "described", ["V1", "V7", "V8"]), ("Q5-1", [], "external", [])]
    assert [tuple(e) for e in row.evidences] == [("1", None, "ECO:1", None, None), ("2", "c", "ECO:2", "a", "2001-01-01")]
    assert tuple(row.signal) == (1, None) and row.features[0].evidence == "1"
    got = sorted(tuple(r) for r in records_xml.isoform_sequences(records).where("accession <> 'P3'").collect())
    assert got == [("P1", "P1", "MKALLV"), ("P1", "P1-1", "MKALLV"), ("P1", "P1-2", "MXYZL"), ("P1", "P1-3", "MXYZLLV"), ("P2", "P2", "ACD")]
    (bad,) = records_xml.corrupt_records(spark, str(tmp_path / "r.xml")).collect()
    assert "<accession>P3</accession>" in bad.record
    table = records_xml.isoform_sequences(records)
    assert sorted(r.isoform for r in accessions.without_canonical_copies(accessions.own_isoforms(table)).where("accession = 'P1'").collect()) == ["P1", "P1-2", "P1-3"]
    chains = spark.createDataFrame([("e", "A", "P1", False), ("e", "B", "P1", True)], "entry string, chain string, accession string, chimera boolean")
    assert sorted((r.chain, r.isoform) for r in accessions.isoform_candidates(chains, table, table).collect()) == [("A", "P1"), ("A", "P1-1"), ("A", "P1-2"), ("A", "P1-3"), ("B", "P1")]


def test_deep_lineages_take_few_rounds(spark, monkeypatch):
    rounds = []
    whole = scoring.cut
    monkeypatch.setattr(scoring, "cut", lambda df: rounds.append(1) or whole(df))
    nodes = spark.createDataFrame([(k, k - 1 if k else None) for k in range(61)] + [(100, 100), (101, 60)], "tax_id int, parent int")
    got = {(r.tax_id, r.ancestor): r.depth for r in scoring.tax_lineage(nodes).collect()}
    assert got == {(a, b): a - b for a in range(61) for b in range(a + 1)} | {(100, 100): 0, (101, 101): 0} | {(101, b): 61 - b for b in range(61)}
    assert len(rounds) <= 1 + 2 * 7
    for deep in (range(66), range(200)):
        with pytest.raises(ValueError, match="deeper"):
            scoring.tax_lineage(spark.createDataFrame([(k, k - 1) for k in deep if k], "tax_id int, parent int"))
