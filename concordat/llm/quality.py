"""Quality rules for documents and, by shrunken failure rates, for their hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, free_name, native_words, stored

#: Fixed values of the contract: fewest words, most words in repeated windows (percent), symbols.
LEAST_WORDS, MOST_REPEATED, SYMBOLS = 50, 50, r"[#*$%&|<>]"
#: Rules whose failures are summed by host, each from the measures of one document.
HOST_RULES = {
    "base": "base_failed",
    "symbols": "10 * n_symbols > n_words",
    "lines": "2 * n_dup_lines > n_lines",
    "words": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 15 * n_words)",
}


def repeated_words(words: Column) -> Column:
    """Number of words that lie in three-word windows found twice or more in the array, first ones included.

    Windows are hashed and sorted with their positions; equal neighbours give the repeated windows, whose positions
    are then sorted and their gaps added up. All within the row, in n log n steps.
    """

    def windows(w: Column) -> Column:
        return F.when(
            F.size(w) > 3,
            F.sort_array(
                F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("at")))
            ),
        ).otherwise(F.array().cast("array<struct<h:bigint,at:int>>"))

    def twins(s: Column) -> Column:
        return F.sort_array(
            F.transform(
                F.filter(s, lambda x, i: F.when(i > 0, F.get(s, i - 1)["h"] == x["h"]).otherwise(False) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))),
                lambda x: x["at"],
            )
        )

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, i: F.coalesce(F.least(F.get(p, i + 1) - x, F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    return bind(words, lambda w: bind(windows(w), lambda s: bind(twins(s), covered)))


def measures(docs: DataFrame, id_column: str = "doc_id", host_column: str = "source") -> DataFrame:
    """id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), F.col(host_column).alias("host"), text.alias("text"), native_words(F.col("text")).alias("w"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def doubles(some: Column) -> Column:
        return F.struct(F.size(some).cast("long").alias("n"), (F.size(some) - F.size(F.array_distinct(some))).cast("long").alias("dup"))

    counted = rows.select(
        "id",
        "host",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        bind(lines, doubles).alias("l"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
    )
    return counted.select(
        "id", "host", "n_words", "word_chars", "n_symbols", F.col("l.n").alias("n_lines"), F.col("l.dup").alias("n_dup_lines"), "n_repeat_words",
        ((F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))).alias("base_failed"),
    )


def host_verdicts(measured: DataFrame, least: float = 0.3, most: float = 0.75) -> DataFrame:
    """(host, host_rate, host_kept): a host is rejected if a rule's shrunken failure rate is beyond what hosts vary by.

    For each rule, a beta prior is fitted to the rates of all hosts by moments (mean of all rows; variance of the
    hosts' rates weighted by rows, less what chance alone gives), and a host's rate is the posterior mean. So hosts
    with few documents are judged mostly as the average host, and one with many as it is; where hosts differ by no more
    than chance, all have the mean. The limit is the mean and three standard deviations of the prior that the other hosts
    give, so that a large host does not hide itself; it is never below ``least``, as most documents of such a host are
    good, nor above ``most``, which is the limit of a host without others. ``host_rate`` is the largest rate.
    One row of moments reaches the driver.
    """
    fails = {r: F.sum(F.expr(rule).cast("long")).cast("double").alias(r) for r, rule in HOST_RULES.items()}
    hosts = stored(measured.groupBy("host").agg(F.count(F.lit(1)).cast("double").alias("n"), *fails.values()))
    zero = F.lit(0.0)
    moments = [x for r in HOST_RULES for x in (F.coalesce(F.sum(r), zero).alias(r), F.coalesce(F.sum(F.col(r) * F.col(r) / F.col("n")), zero).alias(f"{r}_2"))]
    m = hosts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("hosts"), *moments).first()
    rates, good = [], F.lit(True)
    total, n = F.lit(m["n"] or 0.0), F.col("n")
    others = F.nullif(total - n, F.lit(0.0))
    for r in HOST_RULES:
        mean, spread = prior(m["n"] or 0.0, m["hosts"], m[r], m[f"{r}_2"])
        own = n * spread / (n * spread + mean * (1 - mean) - spread) if spread > 0 else F.lit(0.0)
        rates.append(mean + own * (F.col(r) / n - mean))
        mid = (m[r] - F.col(r)) / others
        chance = mid * (1 - mid) * (m["hosts"] - 1) / others
        var = F.greatest(F.lit(0.0), (m[f"{r}_2"] - F.col(r) * F.col(r) / n) / others - mid * mid - chance)
        limit = F.least(F.lit(most), F.greatest(F.lit(least), mid + 3 * F.sqrt(var)))
        good = good & (rates[-1] <= F.when(others.isNull(), most).otherwise(limit))
    return hosts.select("host", F.greatest(*rates).alias("host_rate"), good.alias("host_kept"))


def prior(rows: float, hosts: int, fails: float, squares: float) -> tuple[float, float]:
    """Mean and variance of the beta prior, from sums over hosts: rows, hosts, failures, and failures squared by rows.

    Its weight is mean * (1 - mean) / variance - 1 rows; with no variance beyond chance, that of infinitely many.
    """
    if not rows:  # no hosts either
        return 0.5, 0.0
    mean = fails / rows
    return mean, max(0.0, squares / rows - mean * mean - mean * (1 - mean) * hosts / rows)


def judge_documents(docs: DataFrame, id_column: str = "doc_id", host_column: str = "source", least: float = 0.3, most: float = 0.75) -> DataFrame:
    """Measures and verdicts of every row: id, n_words, ..., base_failed, kept, host_rate.

    A document is kept unless it fails the base rules or its host is rejected. A null text has no words; a null host
    is a host of its own. Repeated rows are documents of their own. Texts are read once: measures are stored, summed
    by host with partial sums, and joined with the verdicts, where adaptive execution can split a hot host.
    """
    measured = stored(measures(docs, id_column, host_column))
    verdicts = stored(host_verdicts(measured, least, most))
    joined = measured.join(verdicts.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
    return joined.select(
        F.col("id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("host_kept")).alias("kept"), "host_rate",
    )


def keep_good(docs: DataFrame, host_column: str = "source", least: float = 0.3, most: float = 0.75) -> DataFrame:
    """``docs`` without those that ``judge_documents`` rejects; measured where they lie, so rows need no id.

    The host verdicts come from a first pass; the second measures again and drops, and its texts are not shuffled by
    host unless the table of hosts is too large to send along.
    """
    base, bad = free_name(docs, "base"), free_name(docs, "bad_host")
    measured = stored(measures(docs.withColumn(base, F.lit(None).cast("long")), base, host_column))
    rejected = host_verdicts(measured, least, most).where(~F.col("host_kept")).select(F.col("host").alias(bad))
    words = native_words(F.col("text"))
    poor = bind(words, lambda w: (F.size(w) < LEAST_WORDS) | (100 * repeated_words(w) > MOST_REPEATED * F.size(w)))
    good = docs.where(~poor)
    return good.join(stored(rejected), good[host_column].eqNullSafe(F.col(bad)), "left_anti")


def quality_sql(documents: str = "documents", least: float = 0.3, most: float = 0.75) -> str:
    """DuckDB SQL for the rows of ``judge_documents`` without the host's rate."""
    rule = {**HOST_RULES}
    sums = ", ".join(f"sum(case when {x} then 1 else 0 end)::double as f_{r}" for r, x in rule.items())
    moments = ", ".join(f"sum(f_{r}) as t_{r}, sum(f_{r} * f_{r} / n) as q_{r}" for r in rule)

    def var(mean: str, squares: str, rows: str, hosts: str) -> str:
        return f"greatest(0, {squares} / {rows} - {mean} * {mean} - {mean} * (1 - {mean}) * {hosts} / {rows})"

    means = ", ".join(f"t_{r} / total as m_{r}, (t_{r} - f_{r}) / nullif(total - n, 0) as o_{r}" for r in rule)
    spread = ", ".join(
        f"{var(f'm_{r}', f'q_{r}', 'total', 'hosts')} as s_{r}, {var(f'o_{r}', f'(q_{r} - f_{r} * f_{r} / n)', '(total - n)', '(hosts - 1)')} as v_{r}" for r in rule
    )
    shrunk = {r: f"m_{r} + case when s_{r} > 0 then n * s_{r} / (n * s_{r} + m_{r} * (1 - m_{r}) - s_{r}) else 0 end * (f_{r} / n - m_{r})" for r in rule}
    good = " and ".join(
        f"{rate} <= case when total = n then {most} else least({most}, greatest({least}, o_{r} + 3 * sqrt(v_{r}))) end" for r, rate in shrunk.items()
    )
    return f"""
    with texts as (select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from {documents}),
    windows as (
      select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as win from texts, lateral unnest(range(1, greatest(len(w) - 1, 1))) r(i)),
    twice as (select doc_id, win from windows group by 1, 2 having count(*) > 1),
    repeated as (
      select doc_id, count(distinct i + k) as n from windows join twice using (doc_id, win), (values (0), (1), (2)) o(k) group by 1),
    lines as (
      select doc_id, count(*) as n_lines, count(*) - count(distinct line) as dup
      from (select doc_id, unnest(string_split(text, chr(10))) as line from texts) where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by 1),
    measured as (
      select t.doc_id, t.source, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols, coalesce(n_lines, 0) as n_lines, coalesce(dup, 0) as n_dup_lines,
        coalesce(r.n, 0) as n_repeat_words, len(w) < {LEAST_WORDS} or 100 * coalesce(r.n, 0) > {MOST_REPEATED} * len(w) as base_failed
      from texts t left join repeated r using (doc_id) left join lines l using (doc_id)),
    hosts as (select source, count(*)::double as n, {sums} from measured group by source),
    moments as (select sum(n) as total, count(*) as hosts, {moments} from hosts),
    means as (select *, {means} from hosts, moments),
    spreads as (select *, {spread} from means),
    verdicts as (select source, {good} as host_kept from spreads)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and host_kept as kept
    from measured m join verdicts v on m.source is not distinct from v.source
    """
