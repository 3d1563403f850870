"""Queries of the problems on texts and matching, and their SQL where there is any."""

from __future__ import annotations

import uuid

from cairnlake.llm import matching, packing, residue, tokens
from cairnlake.session import shared_dir
from cairnlake.sources.tables import table


def _documents(s, d):
    """The corpus, handed to Python in small batches: texts may be long."""
    s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return table(s, d, "documents")


def _p7(s, d):
    """The sizes are written once to the shared folder: the encoding is not repeated for the count and the packing."""
    budgets = table(s, d, "pack_budget")
    names = sorted(r[0] for r in budgets.select("tokenizer").distinct().collect() if r[0])
    at = f"{shared_dir(s)}/sizes-{uuid.uuid4().hex}"
    tokens.sized(_documents(s, d), names).write.parquet(at)
    return packing.packed(s.read.parquet(at), budgets)


def _p8(s, d):
    shared_dir(s)
    return residue.judged(_documents(s, d))


def _four(s, d):
    s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return [table(s, d, n) for n in ("patient", "linkage_record", "specimen", "ingest_source")]


QUERIES = {
    "p4_found": lambda s, d: matching.found(*_four(s, d)),
    "p4_matches": lambda s, d: matching.matches(*_four(s, d)),
    "p6_ids": lambda s, d: tokens.encoded(_documents(s, d)),
    "p7_packed": _p7,
    "p8_found": _p8,
}
ORACLES: dict[str, str] = {}
