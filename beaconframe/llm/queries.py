"""The queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from beaconframe.llm import dedup_exact, html_text, jaccard_join, line_dedup, packing, pieces, quality, simhash, toxicity, warc
from beaconframe.session import table


def exact_dedup(spark, sf_dir: str):
    """op5: which of equal texts stays, for each row of `documents`, whole table and whole texts."""
    return dedup_exact.exact_dedup(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_quality": quality.query,
    "op3_warc": warc.query,
    "op4_jaccard_join": jaccard_join.query,
    "op5_exact_dedup": exact_dedup,
    "op6_simhash": simhash.query,
    "op7_packing": packing.query,
    "op8_html_text": html_text.query,
    "op9_line_dedup": line_dedup.query,
    "op10_pieces": pieces.query,
}
SQL = {"op3_warc": warc.SQL, "op5_exact_dedup": dedup_exact.SQL, "op9_line_dedup": line_dedup.SQL}
