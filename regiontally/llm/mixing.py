"""Mixing sources to target weights by Poisson replication.

Every source gets a target share of the mix; its mean repetition rate is the
rows it should have over the rows it has. Each document draws its number of
copies by inverting the Poisson distribution of that mean at a uniform number
taken from a hash of (seed, doc_id), so the mix is reproducible and no state
crosses tasks. The copies are exploded and dealt out by a hash of (seed,
doc_id, copy), which shuffles them globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.llm.common import table

SEED = "mix-1"
TEMPERATURE = 0.5
PART_MEAN = 64.0  # a larger mean is a sum of draws of at most this mean
BROADCAST_ROWS = 50_000  # 1.6 KB a source at most: 80 MB


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the md5 of the joined parts."""
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(counts: DataFrame, temperature: float = TEMPERATURE, weights: dict[str, float] | None = None) -> DataFrame:
    """(source, n) -> (source, rate): target rows over rows.

    The targets are ``weights`` (relative; a source that is not named gets 0),
    or else the source counts to the power ``temperature``.
    """
    if weights is None:
        wanted = F.pow(F.col("n").cast("double"), F.lit(temperature))
    else:
        named = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else F.create_map()
        wanted = F.coalesce(F.try_element_at(named, F.coalesce("source", F.lit(""))).cast("double"), F.lit(0.0))
    totals = counts.select("source", "n", wanted.alias("w"))
    whole = totals.agg(F.sum("n").alias("rows"), F.sum("w").alias("all"))
    share = F.when(F.col("all") > 0, F.col("w") / F.col("all")).otherwise(F.lit(0.0))
    return totals.join(F.broadcast(whole)).select("source", (share * F.col("rows") / F.col("n")).alias("rate"))


def _thresholds(mean: Column) -> Column:
    """P(X <= k) for k = 0.. of a Poisson of that mean, up to where it is 1 in 52 bits."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("sums"))

    def step(acc, k):
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["sums"], F.array(F.element_at(acc["sums"], -1) + p)).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["sums"])


def mix_sources(docs: DataFrame, temperature: float = TEMPERATURE, weights: dict[str, float] | None = None, seed: str = SEED) -> DataFrame:
    """``docs`` with each row repeated by its draw, plus ``copy`` (0..) and ``mix_key``, in mixed order.

    A null source is a source of its own. Rows that repeat a doc_id draw the
    same number; a null doc_id draws as the text ``null``. Input columns named
    copy or mix_key are replaced. An empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in ("copy", "mix_key")]
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    found = rates(counts, temperature, weights)
    parts = F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int")
    found = found.select(F.col("source").alias("__source"), parts.alias("__parts"), _thresholds(F.col("rate") / parts).alias("__sums"))
    # one row a source; broadcast behind a check, else Spark joins by source and splits the hot ones
    if counts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))

    def draw(part: Column) -> Column:
        u = uniform(F.lit(seed), name, part.cast("string"))
        return F.size(F.filter("__sums", lambda s: s <= u))

    copies = F.aggregate(F.sequence(F.lit(0), F.col("__parts") - 1), F.lit(0), lambda acc, part: acc + draw(part))
    drawn = docs.join(found, docs["source"].eqNullSafe(found["__source"])).withColumn("__copies", copies).filter("__copies > 0")
    out = drawn.select(*[docs[c] for c in kept], F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)).alias("copy"))
    out = out.withColumn("mix_key", F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), name, F.col("copy").cast("string"))))
    return out.repartition(F.col("mix_key")).sortWithinPartitions("mix_key")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


OP7_SQL = f"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rate AS (
  SELECT source, (sqrt(n::DOUBLE) / sum(sqrt(n::DOUBLE)) OVER ()) * (sum(n) OVER ()) / n AS rate FROM n),
part AS (SELECT source, greatest(ceil(rate / {PART_MEAN}), 1)::INT AS parts, rate / greatest(ceil(rate / {PART_MEAN}), 1) AS mean FROM rate),
term AS (
  SELECT source, parts, k, exp(-mean + k * ln(mean) - lgamma(k + 1)) AS p
  FROM part, LATERAL (SELECT unnest(range(0, (mean + 12 * sqrt(mean) + 31)::BIGINT)) AS k)),
cdf AS (SELECT source, parts, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM term),
draw AS (
  SELECT d.*, p.part, ('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || p.part), 1, 13))::BIGINT / {1 << 52}.0 AS u
  FROM documents d JOIN (SELECT source, unnest(range(0, parts)) AS part FROM part) p ON d.source IS NOT DISTINCT FROM p.source),
copies AS (
  SELECT w.doc_id, w.text, w.lang, w.source, w.n_chars, count(c.k) AS n
  FROM draw w LEFT JOIN cdf c ON w.source IS NOT DISTINCT FROM c.source AND c.c <= w.u
  GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy,
       md5('{SEED}:order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy) AS mix_key
FROM copies, LATERAL (SELECT unnest(range(0, n)) AS copy)
"""
