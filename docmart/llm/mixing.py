"""Operator 8 [native]: mix sources to target weights by Poisson replication.

A document of a source with n rows and target weight w is wanted
``w * total / n`` times on average.  Its count comes from inverting the Poisson
distribution of that mean at a uniform number hashed from (seed, id), so it
needs no state, no second pass and no coordination, and a rerun of a lost task
gives the same rows.  Documents are exploded by their counts and shuffled
globally by a hash of (seed, id, copy).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sources up to this number go to all tasks as a small table; with more, rates are joined by a shuffle.
MAX_BROADCAST_SOURCES = 10_000
#: A mean above this is drawn as a sum of several draws, so that the table below never underflows.
MAX_MEAN = 16.0
#: At a mean of 16, P(count >= 96) is far below 2**-52, the step of the uniform numbers: the table cuts nothing off.
TERMS = 96


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a digest."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(mean: Column) -> Column:
    """P(count <= 0), P(count <= 1), ... of a Poisson distribution with a positive mean."""
    log_factorial = lambda k: F.aggregate(F.sequence(F.lit(0), k), F.lit(0.0), lambda acc, i: acc + F.when(i > 1, F.ln(i.cast("double"))).otherwise(0.0))
    pmf = F.transform(F.sequence(F.lit(0), F.lit(TERMS - 1)), lambda k: F.exp(k * F.ln(mean) - mean - log_factorial(k)))
    return F.transform(F.sequence(F.lit(1), F.lit(TERMS)), lambda n: F.aggregate(F.slice(pmf, F.lit(1), n), F.lit(0.0), lambda acc, p: acc + p))


def source_rates(docs: DataFrame, weights: dict[str, float] | None, source: Column, target_rows: int | None) -> DataFrame:
    """(source_key, draws, cdf) of each source with a positive weight."""
    spark = docs.sparkSession
    counts = docs.groupBy(source.alias("source_key")).agg(F.count(F.lit(1)).alias("n"))
    few = counts.limit(MAX_BROADCAST_SOURCES + 1).collect()
    small = len(few) <= MAX_BROADCAST_SOURCES
    if small:
        counts = spark.createDataFrame([(r["source_key"], r["n"]) for r in few], "source_key string, n long")
    if weights is None:
        counts = counts.withColumn("w", F.lit(1.0))
    else:
        wanted = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "source_key string, w double")
        counts = counts.join(wanted, "source_key").where("w > 0")
    sums = counts.agg(F.sum("w").alias("sum_w"), F.sum("n").alias("sum_n"))
    total = F.lit(target_rows) if target_rows is not None else F.col("sum_n")
    rates = counts.crossJoin(F.broadcast(sums)).select("source_key", (F.col("w") / F.col("sum_w") * total / F.col("n")).alias("rate"))  # sums is one row
    rates = rates.withColumn("draws", F.ceil(F.col("rate") / MAX_MEAN).cast("int"))
    rates = rates.select("source_key", "draws", poisson_cdf(F.col("rate") / F.col("draws")).alias("cdf"))
    return F.broadcast(rates) if small else rates


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source", target_rows: int | None = None, seed: int = 20240901) -> DataFrame:
    """Repeat and drop documents so that sources have the target weights, in a global random order.

    ``weights`` gives a share for each source (all equal if None; a source without
    a share is dropped); ``target_rows`` is the size to reach on average (all rows
    of the weighted sources if None).  Returns the input's columns with ``mix_copy``
    (1, 2, ... for a document) and ``mix_order`` (the hash that rows are dealt and sorted by).

    A null source counts as the source ``''``, a null id as the text ``null``.  Rows
    with equal ids get equal counts; texts, null, empty or very long, are only carried along; an empty table gives an empty one.  Input columns that are named mix_copy or mix_order are replaced.
    """
    source, seeds = F.coalesce(F.col(source_col).cast("string"), F.lit("")), F.lit(str(seed))
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    packed = docs.select(F.struct("*").alias("row"), ident.alias("ident"), source.alias("source_key"))
    drawn = packed.join(source_rates(docs, weights, source, target_rows), "source_key")
    # all draws first: inside the inversion a digest would be taken again for each of its steps
    drawn = drawn.withColumn("at", F.transform(F.sequence(F.lit(1), F.col("draws")), lambda j: uniform(seeds, F.col("ident"), j.cast("string"))))
    count = F.aggregate("at", F.lit(0), lambda acc, u: acc + F.size(F.filter("cdf", lambda c: c <= u)))
    drawn = drawn.withColumn("copies", count).where("copies > 0")
    rows = drawn.select("row", "ident", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long"))).alias("mix_copy"))
    rows = rows.withColumn("mix_order", F.md5(F.concat_ws(":", seeds, F.col("ident"), F.col("mix_copy").cast("string"), F.lit("order"))))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("mix_copy", "mix_order")]
    return rows.repartition("mix_order").sortWithinPartitions("mix_order").select(*kept, "mix_copy", "mix_order")


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = f"""
WITH c AS (SELECT coalesce(source, '') AS source_key, count(*) AS n FROM documents GROUP BY 1),
r AS (SELECT source_key, 1.0 / (SELECT count(*) FROM c) * (SELECT sum(n) FROM c) / n AS rate FROM c),
d AS (SELECT source_key, CAST(ceil(rate / {MAX_MEAN}) AS INT) AS draws, rate / ceil(rate / {MAX_MEAN}) AS mean FROM r),
p AS (SELECT source_key, draws, k, exp(k * ln(mean) - mean - coalesce((SELECT sum(ln(i)) FROM range(2, k + 1) t(i)), 0)) AS p
      FROM d, range(0, {TERMS}) s(k)),
f AS (SELECT source_key, draws, sum(p) OVER (PARTITION BY source_key ORDER BY k) AS cdf FROM p),
l AS (SELECT source_key, draws, list(cdf) AS cdf FROM f GROUP BY ALL),
u AS (SELECT documents.*, cdf, coalesce(CAST(doc_id AS VARCHAR), 'null') AS ident, unnest(range(1, draws + 1)) AS j
      FROM documents JOIN l ON coalesce(source, '') = source_key),
k AS (SELECT doc_id, text, lang, source, n_chars, ident,
             sum(len(list_filter(cdf, lambda c: c <= CAST('0x' || substr(md5('20240901:' || ident || ':' || j), 1, 13) AS BIGINT) / {float(1 << 52)}))) AS copies
      FROM u GROUP BY ALL),
e AS (SELECT *, unnest(range(1, CAST(copies AS BIGINT) + 1)) AS mix_copy FROM k)
SELECT doc_id, text, lang, source, n_chars, CAST(mix_copy AS BIGINT) AS mix_copy,
       md5('20240901:' || ident || ':' || mix_copy || ':order') AS mix_order
FROM e
"""
