"""Change events as a document store's change stream publishes them: JSON envelopes.

An envelope names the operation and the document key and, for operations that
leave a document, the whole document after the change::

    {"operationType": "update", "documentKey": {"_id": "U7"}, "fullDocument": {...}}

The report needs documents only. Events without one (deletes, updates of a
document that is gone by now) and texts that are no envelope are dropped and
counted by kind, in the same pass over the events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from regiontally.schemas import USER_SCHEMA
from regiontally.sources.readers import prepare_users

CORRUPT = "_corrupt_record"
ENVELOPE_SCHEMA = StructType(
    [
        StructField("operationType", StringType(), True),
        StructField("documentKey", StructType([StructField("_id", StringType(), True)]), True),
        StructField("fullDocument", USER_SCHEMA, True),
        StructField(CORRUPT, StringType(), True),
    ]
)
DOCUMENT, NO_DOCUMENT, MALFORMED = "document", "no_document", "malformed"
EVENT = "change_event"


def decode(events: DataFrame, column: str = "value") -> DataFrame:
    """``events`` with the decoded envelope as ``change_event`` in place of ``column``."""
    parsed = F.from_json(F.col(column), ENVELOPE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return events.withColumn(EVENT, parsed).drop(column)


def event_kind() -> Column:
    """What a decoded event is good for; a null or broken text is malformed."""
    return F.expr(
        f"CASE WHEN {EVENT} IS NULL OR {EVENT}.{CORRUPT} IS NOT NULL THEN '{MALFORMED}' "
        f"WHEN {EVENT}.fullDocument IS NULL THEN '{NO_DOCUMENT}' ELSE '{DOCUMENT}' END"
    )


def count_columns() -> list[Column]:
    """Conditional counts by kind, for an aggregate or an observation over decoded events."""
    kinds = ((DOCUMENT, "n_documents"), (NO_DOCUMENT, "n_without_document"), (MALFORMED, "n_malformed"))
    return [F.count(F.when(event_kind() == kind, 1)).alias(name) for kind, name in kinds]


def event_counts(events: DataFrame, keys: Sequence[str] = (), column: str = "value") -> DataFrame:
    """Events by kind, per ``keys``."""
    return decode(events, column).groupBy(*keys).agg(*count_columns())


def documents(
    events: DataFrame, carry: Sequence[str] = (), column: str = "value", metrics: str | None = "change_events"
) -> DataFrame:
    """The user documents of the events that have one, key renamed, with the columns ``carry``.

    Works on batch and streaming events. What is dropped is counted on the way by
    an observation named ``metrics`` (a stream reports it with every progress).
    """
    decoded = decode(events, column)
    if metrics:
        decoded = decoded.observe(metrics, *count_columns())
    kept = decoded.where(event_kind() == DOCUMENT)
    return prepare_users(kept.select(f"{EVENT}.fullDocument.*", *carry))
