"""Operators on hits, alignments, residues, segments and snapshots."""
