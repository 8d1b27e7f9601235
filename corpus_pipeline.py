"""Corpus pipeline: quality classifier, SimHash near-dedup, secret scans, mixing, BPE encoding and decoding."""

from tallyfold.llm.pipeline import STAGES, run

#: The classifier, fingerprints by XXH64 and BPE have no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "run"]
