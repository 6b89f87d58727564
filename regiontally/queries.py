"""Named queries over the driver's test tables: ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole ``customer`` / ``nation`` / ``region`` / ``events``
tables through the adapter in :mod:`regiontally.sources.testdata`, so its work
grows with them. Queries that exercise sinks or the stream write under the
session's shared checkpoint folder and return a read-back of what they wrote.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.jobs import logged_report, replay_into_table, report_stats, run_batch_job, run_stream_job
from regiontally.operators.deltas import fold
from regiontally.operators.hierarchy import lookup_broadcastable, region_lookup, resolve_users
from regiontally.operators.report import mortality_report, mortality_report_by_level, top_regions
from regiontally.plans import batch, incremental
from regiontally.schemas import CITY, DISTRICT, REGION, REPORT_COLUMNS
from regiontally.session import shared_dir
from regiontally.sinks.tables import create_report_if_absent, ensure_namespace, full_name, replace_report
from regiontally.sinks.upsert import BEFORE_ALL, UpsertTable
from regiontally.sources import envelope
from regiontally.sources import testdata as td
from regiontally.streaming.runner import log_sink, start_report_stream
from regiontally.streaming.staging import ChangeFeed

Query = Callable[[SparkSession, str], DataFrame]

SINK_NAMESPACE = "analytics"
HOT_PARTITIONS = 256


def _users(spark, d):
    return td.users(spark, d)


def _regions(spark, d):
    return td.regions(spark, d)


def _changes(spark, d):
    return td.user_events(spark, d)


def emptiness_probes(spark: SparkSession, d: str) -> DataFrame:
    users, regions, changes = _users(spark, d), _regions(spark, d), _changes(spark, d)
    small_tree = lookup_broadcastable(regions)
    lookup = region_lookup(regions)
    country_only = users.where("districtId IS NULL AND regionId IS NULL")
    batch_0 = changes.where("batch_id = 0")
    probes = [
        batch.is_empty("users", users),
        batch.is_empty("regions", regions),
        batch.is_empty("users_mapped", resolve_users(users, lookup, broadcast=small_tree)),
        batch.is_empty("change_batch_0", batch_0),
        batch.is_empty("country_only_users_mapped", resolve_users(country_only, lookup, broadcast=small_tree)),
        batch.is_empty("batch_0_deltas", incremental.batch_deltas(batch_0, regions, broadcast=small_tree)),
    ]
    out = probes[0]
    for p in probes[1:]:
        out = out.unionByName(p)
    return out


def _sink_table(spark: SparkSession) -> tuple[str, str]:
    ensure_namespace(spark, f"{SINK_NAMESPACE}.x", location=shared_dir(spark, "warehouse", SINK_NAMESPACE, unique=False))
    name = f"{SINK_NAMESPACE}.mortality_report_{uuid.uuid4().hex[:12]}"
    return name, shared_dir(spark, "tables", name)


def sink_replace_report(spark: SparkSession, d: str) -> DataFrame:
    """Write the report as a table, refresh it a second time, read it back."""
    report = batch.mortality_report(_users(spark, d), _regions(spark, d), ordered=False)
    name, location = _sink_table(spark)
    replace_report(report, name, location=location)
    replace_report(report, name, location=location)
    return spark.table(full_name(name)).select(*REPORT_COLUMNS)


def sink_create_if_absent(spark: SparkSession, d: str) -> DataFrame:
    """Create the empty table, fill it, create again (a no-op), read it back."""
    report = batch.mortality_report(_users(spark, d), _regions(spark, d), ordered=False)
    name, location = _sink_table(spark)
    table = create_report_if_absent(spark, name, location=location)
    report.select(*REPORT_COLUMNS).write.insertInto(table)
    create_report_if_absent(spark, name, location=location)
    return spark.table(table).select(*REPORT_COLUMNS)


def sink_failed_replace(spark: SparkSession, d: str) -> DataFrame:
    """A replace that fails while it writes leaves the table's rows as they were."""
    report = batch.mortality_report(_users(spark, d), _regions(spark, d), ordered=False)
    name, location = _sink_table(spark)
    replace_report(report, name, location=location)
    broken = report.withColumn("region_name", F.expr("raise_error(concat('cannot write ', region_id))"))
    try:
        replace_report(broken, name, location=location)
    except Exception as error:
        if "cannot write" not in str(error):
            raise
    return spark.table(full_name(name)).select(*REPORT_COLUMNS)


def report_after_stream_with_baseline(spark: SparkSession, d: str) -> DataFrame:
    """All 30 micro-batches upserted into the batch report (the size bound is taken once)."""
    users, regions, changes = _users(spark, d), _regions(spark, d), _changes(spark, d)
    small_tree = lookup_broadcastable(regions)
    baseline = mortality_report(users, regions, broadcast=small_tree)
    return incremental.report_after_stream(changes, regions, baseline, broadcast=small_tree)


def top20_after_stream(spark: SparkSession, d: str) -> DataFrame:
    """The stats readback: top 20 of the report after every micro-batch was upserted."""
    return top_regions(report_after_stream_with_baseline(spark, d), 20)


def stream_users_to_report(spark: SparkSession, d: str) -> DataFrame:
    """A real streaming run: events staged once, released one day at a time into the watched
    folder of one running query (30 micro-batches, one per day), logged and folded."""
    work = shared_dir(spark, "stream")
    log = incremental.run_stream(spark, td.raw_changes(spark, d), _regions(spark, d), work)
    return fold(log)


def _upsert_target(spark: SparkSession) -> UpsertTable:
    name, location = _sink_table(spark)
    return UpsertTable.create(spark, name, buckets=16, location=location)


def _upsert_batches(target: UpsertTable, spark: SparkSession, d: str, times: int = 1, days: int = 1) -> UpsertTable:
    """Every micro-batch (of so many days) of the changes upserted in order, each ``times`` times."""
    changes = _changes(spark, d).withColumn("batch_id", F.expr(f"batch_id DIV {days}"))
    rows = incremental.batch_deltas(changes, _regions(spark, d), with_parent=True).persist()
    try:
        batches = sorted(r["batch_id"] for r in rows.select("batch_id").distinct().collect())
        for number in batches:
            for _ in range(times):
                rows.where(F.col("batch_id") == number).createOrReplaceTempView("source_deltas")
                target.upsert_view(spark, "source_deltas", (0, number))
    finally:
        rows.unpersist()
    return target


def _upserted_over_report(spark: SparkSession, d: str, days: int = 1) -> UpsertTable:
    target = _upsert_target(spark)
    target.refresh(batch.mortality_report(_users(spark, d), _regions(spark, d), ordered=False), BEFORE_ALL)
    return _upsert_batches(target, spark, d, days=days)


def upsert_table(spark: SparkSession, d: str) -> DataFrame:
    """The batch report in the bucketed table, then every micro-batch upserted into it."""
    return _upserted_over_report(spark, d).report(spark)


def upsert_table_replayed(spark: SparkSession, d: str) -> DataFrame:
    """Every micro-batch upserted twice into an empty table: counted once."""
    return _upsert_batches(_upsert_target(spark), spark, d, times=2).report(spark)


def stats_from_table(spark: SparkSession, d: str) -> DataFrame:
    """The stats readback: the table after all changes (in six-day batches), read by its name."""
    return report_stats(spark, _upserted_over_report(spark, d, days=6).name.partition(".")[2])


def report_after_stream_decimal(spark: SparkSession, d: str) -> DataFrame:
    """The batch report with every micro-batch folded in, rates in the upsert's decimal arithmetic."""
    regions = _regions(spark, d)
    log = incremental.as_log(incremental.batch_deltas(_changes(spark, d), regions, with_parent=True))
    return fold(log, mortality_report(_users(spark, d), regions), rate_arithmetic="decimal")


def report_state_compacted(spark: SparkSession, d: str) -> DataFrame:
    """The batch report as a table, every micro-batch logged, the log folded into the table's next version."""
    name, location = _sink_table(spark)
    log = shared_dir(spark, "log")
    baseline = run_batch_job(spark, _users(spark, d), _regions(spark, d), name, location=location)
    rows = incremental.as_log(incremental.batch_deltas(_changes(spark, d), _regions(spark, d), with_parent=True))
    rows.write.partitionBy("epoch", "batch_id").mode("append").parquet(log)
    replace_report(logged_report(spark, log, baseline), name, location=location)
    return spark.table(full_name(name)).select(*REPORT_COLUMNS)


def report_state_refreshed(spark: SparkSession, d: str) -> DataFrame:
    """All changes upserted (in six-day batches), then the batch job: a refresh replaces the report."""
    target = _upserted_over_report(spark, d, days=6)
    return run_batch_job(spark, _users(spark, d), _regions(spark, d), target=target)


def _feed(spark: SparkSession, d: str, work: str, batch_of: str) -> tuple[ChangeFeed, list[int]]:
    """The changes staged for a stream, in micro-batches of the given SQL expression."""
    feed = ChangeFeed(spark, f"{work}/feed", incremental.BATCH_KEY)
    changes = td.raw_changes(spark, d).select(*incremental.STAGED_FIELDS, F.expr(batch_of).alias(incremental.BATCH_KEY))
    return feed, feed.stage(changes)


def stream_to_table(spark: SparkSession, d: str) -> DataFrame:
    """A real stream, one micro-batch per day, upserted batch by batch into a catalog table; read by name."""
    work = shared_dir(spark, "stream-table")
    name, location = _sink_table(spark)
    feed, days = _feed(spark, d, work, "batch_id")
    handle = run_stream_job(
        spark, feed.stream(), _regions(spark, d), f"{work}/checkpoint", name, buckets=16, location=location,
        trigger=incremental.CONTINUOUS,
    )
    incremental.deliver(feed, days, handle)
    return UpsertTable.create(spark, name).report(spark)


def stream_dead_letters(spark: SparkSession, d: str) -> DataFrame:
    """A real stream of six-day batches whose first batch is refused: it is kept, the stream goes
    on, and the kept batch is replayed into the table afterwards (twice, counted once)."""
    work = shared_dir(spark, "stream-letters")
    name, location = _sink_table(spark)
    feed, batches = _feed(spark, d, work, "batch_id DIV 6")

    def refuse_first(rows: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            raise ValueError("refused")

    handle = run_stream_job(
        spark, feed.stream(), _regions(spark, d), f"{work}/checkpoint", name, buckets=16, location=location,
        trigger=incremental.CONTINUOUS, check=refuse_first, dead_letters=f"{work}/letters",
    )
    incremental.deliver(feed, batches, handle)
    target = UpsertTable.create(spark, name)
    for _ in range(2):
        replay_into_table(spark, f"{work}/letters", _regions(spark, d), target)
    return target.report(spark)


#: Even batches hold a week's changes of users whose anchor may resolve, odd ones those of which none can.
SPLIT_WEEKS = "2 * (batch_id DIV 7) + CAST(coalesce(districtId, regionId, 'D-missing') = 'D-missing' AS INT)"


def stream_skip_rules(spark: SparkSession, d: str) -> DataFrame:
    """A real stream in which every other batch resolves nobody: delta rows per batch, and whether it was reported."""
    work = shared_dir(spark, "stream-skips")
    feed, batches = _feed(spark, d, work, SPLIT_WEEKS)
    reported: dict[int, int] = {}
    handle = start_report_stream(
        feed.stream(), _regions(spark, d), log_sink(f"{work}/log"), f"{work}/checkpoint", epoch=0,
        trigger=incremental.CONTINUOUS, after_batch=reported.__setitem__,
    )
    incremental.deliver(feed, batches, handle)
    rows = [(i, reported.get(i, 0), i in reported) for i in range(len(batches))]
    return spark.createDataFrame(rows, "batch_id bigint, n_delta_rows bigint, reported boolean")


def change_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Every event as a change-stream envelope (``event_id, batch_id, value``): errors are deletes,
    an event of a user that has no document carries none, and every 50th text is cut off."""
    events = td.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    joined = events.join(td.user_base(spark, d), F.expr("user_id = c_custkey"), "left")
    operation = "CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' ELSE 'update' END"
    document = (
        "CASE WHEN event_type <> 'error' AND c_custkey IS NOT NULL "
        "THEN named_struct('_id', _id, 'regionId', regionId, 'districtId', districtId, 'active', active) END"
    )
    text = (
        f"to_json(named_struct('operationType', {operation}, "
        f"'documentKey', named_struct('_id', concat('U', user_id)), 'fullDocument', {document}))"
    )
    return joined.selectExpr(
        "event_id",
        f"CAST(datediff(to_date(ts), DATE '{td.STREAM_EPOCH_START}') AS BIGINT) AS batch_id",
        f"CASE WHEN event_id % 50 = 7 THEN left({text}, length({text}) - 1) ELSE {text} END AS value",
    )


def change_envelope_documents(spark: SparkSession, d: str) -> DataFrame:
    """The user documents that the envelopes carry."""
    found = envelope.documents(change_envelopes(spark, d), carry=["event_id"])
    return found.select("event_id", "user_doc_id", "regionId", "districtId", "active")


def queries() -> dict[str, Query]:
    return {
        "scan_users": lambda s, d: batch.scan_users(_users(s, d)),
        "scan_regions": lambda s, d: batch.scan_regions(_regions(s, d)),
        "regions_by_level": lambda s, d: batch.regions_by_level(_regions(s, d)),
        "users_via_district": lambda s, d: batch.users_via(_users(s, d), _regions(s, d), DISTRICT),
        "users_via_city": lambda s, d: batch.users_via(_users(s, d), _regions(s, d), CITY),
        "users_via_region": lambda s, d: batch.users_via(_users(s, d), _regions(s, d), REGION),
        "users_mapped": lambda s, d: batch.users_mapped(_users(s, d), _regions(s, d)),
        # The path taken when the tree is too large to broadcast: salted shuffle join.
        "users_mapped_large_tree": lambda s, d: batch.users_mapped(_users(s, d), _regions(s, d), 0),
        # The same with shares so small that the missing district and the REGIONs are hot anchors.
        "users_mapped_hot_anchors": lambda s, d: batch.users_mapped(_users(s, d), _regions(s, d), 0, HOT_PARTITIONS),
        "users_mapped_by_branches": lambda s, d: batch.users_mapped_by_level(_users(s, d), _regions(s, d)),
        "preview_mapped": lambda s, d: batch.preview_mapped(_users(s, d), _regions(s, d)),
        "total_population": lambda s, d: batch.total_population(_users(s, d), _regions(s, d)),
        "dead_population": lambda s, d: batch.dead_population(_users(s, d), _regions(s, d)),
        "report_base": lambda s, d: batch.report_base(_regions(s, d)),
        "mortality_report": lambda s, d: batch.mortality_report(_users(s, d), _regions(s, d)),
        "mortality_report_large_tree": lambda s, d: batch.mortality_report(_users(s, d), _regions(s, d), True, 0),
        # The same report counted level by level.
        "mortality_report_branch_shape": lambda s, d: mortality_report_by_level(_users(s, d), _regions(s, d)),
        "top20_regions": lambda s, d: batch.top20_regions(_users(s, d), _regions(s, d)),
        "region_parents": lambda s, d: batch.region_parents(_regions(s, d)),
        "batch_deltas": lambda s, d: incremental.batch_deltas(_changes(s, d), _regions(s, d)),
        "batch_deltas_with_parent": lambda s, d: incremental.batch_deltas(
            _changes(s, d), _regions(s, d), with_parent=True
        ),
        "merge_one_batch": lambda s, d: incremental.merge_one_batch(_users(s, d), _regions(s, d), _changes(s, d)),
        "report_after_stream_with_baseline": report_after_stream_with_baseline,
        "top20_after_stream": top20_after_stream,
        "report_after_stream_empty": lambda s, d: incremental.report_after_stream(_changes(s, d), _regions(s, d)),
        "stream_users_to_report": stream_users_to_report,
        "emptiness_probes": emptiness_probes,
        "side_table_counts": lambda s, d: batch.side_table_counts(_regions(s, d)),
        "sink_replace_report": sink_replace_report,
        "sink_create_if_absent": sink_create_if_absent,
        "report_state_compacted": report_state_compacted,
        "report_state_refreshed": report_state_refreshed,
        "stream_to_table": stream_to_table,
        "sink_failed_replace": sink_failed_replace,
        "upsert_table": upsert_table,
        "upsert_table_replayed": upsert_table_replayed,
        "stats_from_table": stats_from_table,
        "report_after_stream_decimal": report_after_stream_decimal,
        "stream_dead_letters": stream_dead_letters,
        "stream_skip_rules": stream_skip_rules,
        "change_envelope_counts": lambda s, d: envelope.event_counts(change_envelopes(s, d), ["batch_id"]),
        "change_envelope_documents": change_envelope_documents,
    }
