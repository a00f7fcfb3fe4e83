"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored

#: Means above this are drawn as a sum of equal parts, each with its own hash.
PART_MEAN = 16.0
#: A part of that mean exceeds it with a probability far below the 2^-52 that a hash can tell.
PART_COPIES = 127


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of the parts, colon-joined."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def poisson_steps(mean: Column) -> Column:
    """P(X <= k) for k from 0 to PART_COPIES, as an array."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), F.array(first).alias("c"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(PART_COPIES)), start, step, lambda acc: acc["c"])


def repetition_rates(docs: DataFrame, group: str, size: Column, weights: Mapping[str, float] | None, budget: float | None) -> DataFrame:
    """(group, rate, parts, steps): mean copies of each document of a group that give the group its share of the budget.

    ``weights`` need not add up to 1; without them all groups weigh the same, null being a group. Groups not in it get
    no copies. The budget is in units of ``size`` and is the size of the whole input unless given.
    """
    sizes = stored(docs.groupBy(F.col(group).alias("group")).agg(F.sum(size.cast("double")).alias("size")))
    if weights is None:
        weighed = sizes.withColumn("weight", F.lit(1.0))
    else:
        table = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "name string, weight double")
        weighed = sizes.join(table, F.col("group").cast("string").eqNullSafe(F.col("name")), "left").drop("name").fillna(0.0, ["weight"])
    whole = weighed.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    if not whole["weight"] or not whole["size"]:
        rate = F.lit(0.0)
    else:
        share = (whole["size"] if budget is None else float(budget)) / whole["weight"]
        rate = F.when(F.col("size") > 0, F.lit(share) * F.col("weight") / F.col("size")).otherwise(0.0)
    rated = weighed.select("group", rate.alias("rate"))
    rated = rated.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN)).cast("long"))
    return stored(rated.withColumn("steps", poisson_steps(F.col("rate") / F.col("parts"))))


def poisson_mixture(
    docs: DataFrame,
    group: str = "source",
    key: str = "doc_id",
    size: Column | None = None,
    weights: Mapping[str, float] | None = None,
    budget: float | None = None,
    seed: int = 42,
) -> DataFrame:
    """``docs`` with each document repeated a Poisson number of times, in an order shuffled over the whole result.

    The number comes from inverting the Poisson distribution, whose mean is the target repetition rate of the document's
    group, at a uniform number from the hash of seed and key: a task that runs again draws the same, and a document's
    number changes only with its rate. Columns added last (with underscores before them if taken): ``copy`` (unique within a document, from 1 without gaps up to a
    mean of 16) and ``shuffle_key``, by whose hash copies are dealt over partitions and by which they are sorted there.

    ``size`` is the UTF-8 length of the text plus one (one for null) unless given. Repeated rows of one key are repeated
    equally often. A null group is a group, a null key hashes as the word null. No rows give no rows. The table of
    rates has a row for each group; it is joined, so a hot group is dealt out like any other.
    """
    if size is None:
        size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    rates = repetition_rates(docs, group, size, weights, budget)
    names = {n: free_name(docs, n) for n in ("group", "rate", "parts", "steps", "part", "number")}
    copy, order = free_name(docs, "copy"), free_name(docs, "shuffle_key")
    rates = rates.select(*(F.col(n).alias(names[n]) for n in ("group", "rate", "parts", "steps")))
    part, number = names["part"], names["number"]
    joined = docs.join(rates, docs[group].eqNullSafe(rates[names["group"]]))
    parted = joined.withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.col(names["parts"]) - 1)))
    drawn = parted.withColumn(number, uniform(F.lit(seed), F.col(key), F.col(part)))
    count = F.size(F.filter(names["steps"], lambda x: x <= F.col(number)))
    counted = drawn.withColumn(number, count).where(F.col(number) > 0)
    numbers = F.explode(F.sequence(F.lit(1).cast("long"), F.col(number).cast("long")))
    copies = counted.withColumn(copy, numbers).withColumn(copy, F.col(copy) + F.col(part) * PART_COPIES)
    text = F.concat_ws(":", F.lit(seed).cast("string"), F.lit("order"), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.col(copy).cast("string"))
    keyed = copies.withColumn(order, F.substring(F.md5(text.cast("binary")), 1, 16)).drop(*names.values())
    return keyed.repartition(order).sortWithinPartitions(order, key)


def mixture_sql(documents: str = "documents", seed: int = 42, columns: str = "d.*") -> str:
    """DuckDB SQL for equal weights and the whole size as budget, for means that one part covers."""
    return f"""
    with recursive sizes as (
      select source, sum(octet_length(encode(coalesce(text, ''))) + 1)::double as size from {documents} group by source),
    whole as (select sum(size) / count(*)::double as share from sizes),
    rates as (
      select source, share * 1.0::double / size as rate,
        greatest(1, ceil((share * 1.0::double / size) / 16.0)::bigint) as parts from sizes, whole),
    steps as (
      select source, 0 as k, parts, rate / parts as mean, exp(-(rate / parts)) as p, exp(-(rate / parts)) as c from rates
      union all
      select source, k + 1, parts, mean, p * mean / (k + 1), c + p * mean / (k + 1) from steps where k < {PART_COPIES}),
    cumulated as (select source, parts, list(c order by k) as c from steps group by source, parts),
    drawn as (
      select d.*, part, ('0x' || substr(md5('{seed}:' || coalesce(d.doc_id::varchar, 'null') || ':' || part::varchar), 1, 13))::bigint
        / 4503599627370496.0::double as u, c
      from {documents} d join cumulated r on d.source is not distinct from r.source, lateral unnest(range(0, r.parts)) x(part)),
    counted as (select *, len(list_filter(c, lambda x: x <= u)) as n from drawn),
    copied as (select *, part * {PART_COPIES} + k as copy from counted, lateral unnest(range(1, n + 1)) y(k))
    select {columns}, copy::bigint as copy,
      substr(md5('{seed}:order:' || coalesce(d.doc_id::varchar, 'null') || ':' || copy::varchar), 1, 16) as shuffle_key
    from copied d
    """
