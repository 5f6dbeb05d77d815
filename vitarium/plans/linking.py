"""End-to-end plan: records to occupation statements."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vitarium.fixed import MIN_CONFIDENCE
from vitarium.operators.occupations import occupation_model, occupation_seeds, statements, suggest
from vitarium.operators.records import Seq


def link_occupations(records: DataFrame, *, record_id: Seq, seeds: DataFrame | None = None,
                     activity: str = "activity", url: str = "url", qid: str = "wikidata_qid",
                     min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Statements for every record, from the built-in vocabulary or a seeds table."""
    model = occupation_model(occupation_seeds(records.sparkSession) if seeds is None else seeds)
    found = suggest(records, model, record_id=record_id, activity=activity, min_confidence=min_confidence)
    return statements(records, found, record_id=record_id, activity=activity, url=url, qid=qid)
