"""regiontally: per-REGION population and inactivity reports on Spark.

Batch: :func:`regiontally.operators.report.mortality_report`; streaming:
:func:`regiontally.jobs.run_stream_job` with state in
:class:`regiontally.sinks.upsert.UpsertTable`. See README.md.
"""

__version__ = "0.1.0"
