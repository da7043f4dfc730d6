"""A corpus pipeline: five stages over documents, each written as Parquet and read back by the next."""

from __future__ import annotations

from ledgerloom.llm import jaccard_join, mixing, packing, pii, toxicity
from ledgerloom.llm.common import stored, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("near_duplicates", jaccard_join.stage),
    ("pii", pii.stage),
    ("mixing", mixing.stage),
    ("packing", packing.stage),
]

#: SQL can't express the stages 1, 2 and 5; tests/llm hold each against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Rows of the last stage: where each piece of each remaining document is packed.

    Each stage handles null, empty, long and repeated texts and ids as its docstring says; an empty table of documents gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
