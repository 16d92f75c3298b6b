"""Poisson replication: sources brought to target weights by whole copies of documents.

Each source has a mean repetition rate: its share of the target over its share of the corpus, in
bytes. A document's copy count inverts the Poisson distribution of that rate at a uniform number
that is a hash of seed and document id, so a rerun or a lost executor gives the same counts. The
rate table has a row per source and holds the distribution's cumulative sums, computed once per
source in log space; per document there is one lookup. Copies are then dealt to partitions and
sorted there by a hash of (seed, id, copy): a global shuffle without a range sample. A rate above
``MAX_RATE`` is split into equal parts: the count is the sum of one draw a part, each from a hash of
its own, so no row of the table grows with the rate itself and every rate is met.

Defined cases: a null source is a source of its own; a null id hashes as the empty string; a null
text counts as 1 byte, as an empty one; repeated rows get the same count each; an empty table gives
an empty result; input columns named as an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .sharding import doc_size

SEED = "mix-1"
#: Without explicit weights, a source's target share is proportional to its bytes to this power.
ALPHA = 0.5
#: The mean of one draw at most (or the square root of the rate, if that is more); larger rates are sums of draws.
MAX_RATE = 64.0
#: Up to so many sources the rate table is broadcast (about 1 KB a row); beyond, Spark joins by shuffle.
MAX_BROADCAST_SOURCES = 10_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of the parts."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16 ** 13)


def poisson_cdf(rate: Column) -> Column:
    """P(X <= k) for k from 0 to where the tail is below double precision, by the recurrence of ln P(X = k)."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30)
    step = lambda s, k: F.struct(
        (s["logp"] + F.log(rate) - F.log(k.cast("double"))).alias("logp"),
        (F.element_at(s["cdf"], -1) + F.exp(s["logp"] + F.log(rate) - F.log(k.cast("double")))).alias("next"),
        s["cdf"].alias("cdf"))
    grow = lambda s, k: F.transform(F.array(step(s, k)), lambda x: F.struct(
        x["logp"].alias("logp"), F.concat(x["cdf"], F.array(x["next"])).alias("cdf")))[0]
    start = F.struct((-rate).alias("logp"), F.array(F.exp(-rate)).alias("cdf"))
    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), last), start, grow, lambda s: s["cdf"])) \
            .otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA) -> DataFrame:
    """source, size, rate: the mean copies of a document of each source.

    The total stays what it is, on average. ``weights`` (source -> share; others get 0) replaces bytes ** alpha.
    """
    sizes = docs.groupBy("source").agg(F.sum(doc_size(F.col("text"))).alias("size"))
    if weights is None:
        target = F.pow(F.col("size").cast("double"), F.lit(float(alpha)))
    else:
        pairs = [F.lit(x) for k, v in weights.items() for x in (k, float(v))]
        target = F.coalesce(F.create_map(*pairs)[F.col("source")], F.lit(0.0)) if pairs else F.lit(0.0)
    shares = sizes.withColumn("target", target)
    all_size, all_target = shares.agg(F.sum("size"), F.sum("target")).first()
    share = F.col("target") / F.lit(all_target) if all_target else F.lit(0.0)
    rate = share * F.lit(all_size or 0) / F.col("size")
    return shares.select("source", "size", rate.alias("rate"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA,
        seed: str = SEED) -> DataFrame:
    """``docs`` with each row repeated, plus n_copies, copy (from 1) and shuffle_key, in shuffled order."""
    spark = docs.sparkSession
    common.prepare(spark)
    rates = source_rates(docs, weights, alpha)
    known = [tuple(r) for r in rates.limit(MAX_BROADCAST_SOURCES + 1).collect()]
    if len(known) <= MAX_BROADCAST_SOURCES:
        rates = F.broadcast(spark.createDataFrame(known, rates.schema).coalesce(1))
    parts = F.greatest(F.ceil(F.col("rate") / F.greatest(F.lit(MAX_RATE), F.sqrt("rate"))), F.lit(1)).cast("int")
    cdf = rates.select(F.col("source").alias("_source"), parts.alias("_parts"), poisson_cdf(F.col("rate") / parts).alias("_cdf"))
    hashes = F.transform(F.sequence(F.lit(1), F.col("_parts")), lambda part: F.when(
        part == 1, uniform(F.lit(seed), F.col("doc_id"))).otherwise(uniform(F.lit(seed), F.col("doc_id"), F.lit("draw"), part)))
    draws = F.transform(hashes, lambda u: F.size(F.filter("_cdf", lambda c: c <= u)))
    counted = (docs.join(cdf, F.col("source").eqNullSafe(F.col("_source")))
               .withColumn("_draws", draws)
               .withColumn("n_copies", F.aggregate("_draws", F.lit(0), lambda a, n: a + n))
               .drop("_source", "_cdf", "_parts").filter("n_copies > 0"))
    # a row per draw with the copies before it, so that no row holds an array of all copies
    ends = F.aggregate("_draws", F.array().cast("array<int>"),
                       lambda a, n: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + n)))
    runs = F.transform(F.arrays_zip(ends.alias("end"), F.col("_draws").alias("n")),
                       lambda x: F.struct((x["end"] - x["n"] + 1).alias("first"), x["end"].alias("last")))
    counted = counted.withColumn("_run", F.explode(F.filter(runs, lambda r: r["first"] <= r["last"]))).drop("_draws")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                            F.col("copy").cast("string")).cast("binary"))
    copies = (counted.drop("copy").withColumn("copy", F.explode(F.sequence("_run.first", "_run.last"))).drop("_run")
              .withColumn("shuffle_key", key))
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def op9_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents at target weights, with their copies."""
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return mix(docs)


OP9_SQL = f"""
WITH sizes AS (
  SELECT source, sum(coalesce(strlen(text), 0) + 1) AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes) * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes),
parted AS (
  SELECT source, rate, CAST(greatest(ceil(rate / greatest({MAX_RATE}, sqrt(rate))), 1) AS BIGINT) AS parts FROM rates),
means AS (SELECT source, parts, rate / parts AS mean FROM parted),
pmf AS (
  SELECT source, k, exp(k * ln(mean) - mean - lgamma(k + 1)) AS p
  FROM (SELECT *, unnest(range(0, CAST(ceil(mean + 12 * sqrt(mean) + 30) AS BIGINT) + 1)) AS k FROM means)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM pmf),
docs AS (SELECT *, row_number() OVER () AS row_id, '{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') AS seed FROM documents),
draws AS (
  SELECT row_id, source, CAST('0x' || left(md5(seed || CASE WHEN part = 1 THEN '' ELSE ':draw:' || part END), 13) AS BIGINT)
                         / 4503599627370496.0 AS u
  FROM (SELECT d.row_id, d.source, d.seed, unnest(range(1, m.parts + 1)) AS part
        FROM docs d JOIN means m ON d.source IS NOT DISTINCT FROM m.source)),
counted AS (
  SELECT row_id, CAST(sum((SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM draws.source AND cdf.c <= draws.u)) AS INTEGER) AS n_copies
  FROM draws GROUP BY row_id)
SELECT doc_id, text, lang, source, n_chars, n_copies, CAST(copy AS INTEGER) AS copy, md5(seed || ':' || copy) AS shuffle_key
FROM (SELECT d.*, n_copies, unnest(range(1, n_copies + 1)) AS copy FROM docs d JOIN counted USING (row_id) WHERE n_copies > 0)
"""
