"""Change-stream envelopes: documents are kept, everything else is dropped and counted."""

from __future__ import annotations

from regiontally.session import shared_dir
from regiontally.sources.envelope import documents, event_counts

EVENTS = [
    (1, '{"operationType":"insert","documentKey":{"_id":"a"},"fullDocument":{"_id":"a","regionId":"R1","active":true}}'),
    (1, '{"operationType":"delete","documentKey":{"_id":"a"}}'),
    (1, '{"operationType":"update","documentKey":{"_id":"b"},"fullDocument":null}'),
    (2, '{"operationType":"update","documentKey":{"_id":"c"},"fullDocument":{"_id":"c","unknown":[1]}}'),
    (2, '{"operationType":"insert","fullDocument":{"_id":"d"'),
    (2, "not json"),
    (2, None),
    (3, '{"operationType":"invalidate"}'),
    (3, '{"operationType":"insert","fullDocument":{"_id":"e","active":"yes"}}'),
]


def _events(spark):
    return spark.createDataFrame(EVENTS, "day int, value string")


def test_counts_by_kind(spark):
    got = {r.day: (r.n_documents, r.n_without_document, r.n_malformed) for r in event_counts(_events(spark), ["day"]).collect()}
    assert got == {1: (1, 2, 0), 2: (1, 0, 3), 3: (0, 1, 1)}  # a field of another type makes a text malformed


def test_documents_have_the_declared_columns(spark):
    df = documents(_events(spark), carry=["day"])
    assert {"user_doc_id", "regionId", "districtId", "active", "day"} <= set(df.columns)
    assert sorted((r.day, r.user_doc_id, r.regionId, r.active) for r in df.collect()) == [(1, "a", "R1", True), (2, "c", None, None)]


def test_no_events(spark):
    assert documents(_events(spark).limit(0)).isEmpty()
    assert event_counts(_events(spark).limit(0), ["day"]).isEmpty()


def test_a_stream_reports_what_it_dropped(spark):
    work = shared_dir(spark, "test-envelope")
    _events(spark).write.parquet(f"{work}/in")
    stream = spark.readStream.schema("day int, value string").parquet(f"{work}/in")
    seen = []
    query = (
        documents(stream, metrics="changes")
        .writeStream.foreachBatch(lambda df, i: seen.extend(r.user_doc_id for r in df.collect()))
        .option("checkpointLocation", f"{work}/ckpt")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(seen) == ["a", "c"]
    metrics = query.recentProgress[0]["observedMetrics"]["changes"]
    assert (metrics["n_documents"], metrics["n_without_document"], metrics["n_malformed"]) == (2, 3, 4)
