"""Line-level deduplication by a suffix array over line-ID sequences, built by distributed prefix doubling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, free_name, native_words, stored

#: A line ends where the next one has a word, so blank lines belong to the line before them.
BREAK = r"\n(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])"
LOWEST = -(2**63)


def line_units(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), BREAK)


def key_of(docs: DataFrame, id_column: str) -> Column:
    """The id as it is ordered and joined, never null: whole numbers as longs, any other type within a struct."""
    column = docs[id_column]
    if isinstance(docs.schema[id_column].dataType, T.IntegralType):
        return F.coalesce(column.cast("long"), F.lit(LOWEST))
    return F.struct(column.alias("v"))


def keys_of(docs: DataFrame, id_column: str) -> list[Column]:
    """Document order: id (null first), then text hash. Rows equal in both are one document."""
    return [key_of(docs, id_column).alias("id"), F.xxhash64("text").alias("th")]


def ranked(rows: DataFrame, first: str, second: str) -> DataFrame:
    """``rows`` whose pair of ranks occurs twice or more, with ``rank``: the place of the pair among all such pairs.

    Pairs are counted with partial sums, sorted over range partitions and numbered in that order (with gaps).
    """
    pairs = rows.groupBy(first, second).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    places = stored(pairs.orderBy(first, second).select(first, second, F.monotonically_increasing_id().alias("rank")))
    joined = stored(rows.join(places, [first, second]).drop(first, second))
    discard(places)
    return joined


def repeated_lines(docs: DataFrame, id_column: str = "doc_id", least_words: int = 50) -> DataFrame:
    """(id, th, lines): line numbers of each document that lie in a later copy of a run of ``least_words`` words or more.

    A run is lines of one document in sequence; its words are counted together, and blank lines do not part it. It is
    a later copy if the same run begins earlier: in a document with a smaller id, or further up. Lines are equal if
    their words are.

    Round 0 ranks lines by identity and drops those that occur once; what is left falls into stretches, and stretches
    of too few words are dropped as well. Round k ranks windows of 2^k lines by the ranks of their halves, dropping
    unique ones, as long as windows of ``least_words`` words need it: that is the suffix array by prefix doubling, for
    the suffixes that have a neighbour with a common prefix. A window of any length is then named by its length and
    the ranks of its first and last 2^k lines. All suffixes with one name are an interval of the array with a common
    prefix of at least that many lines, and every maximal repeated run of enough words is a union of such windows:
    the shortest ones of enough words from each line forwards, and from each line backwards.
    """
    units = docs.select(*keys_of(docs, id_column), F.posexplode(line_units(F.col("text"))).alias("i", "unit"))
    words = units.select("id", "th", "i", native_words(F.col("unit")).alias("w")).where(F.size("w") > 0)
    joined = F.array_join("w", " ")
    lines = stored(words.select("id", "th", "i", F.size("w").alias("n_words"), F.xxhash64(joined).alias("one"), F.hash(joined).alias("two")))
    known = ranked(lines, "one", "two")

    document = ["id", "th"]
    along = Window.partitionBy(*document).orderBy("i")
    # rows equal in id and text are one document: a minimum, which combines before the shuffle
    once = known.groupBy(*document, "i").agg(F.min("n_words").alias("n_words"), F.min("rank").alias("rank"))
    apart = F.sum((F.col("i") - F.coalesce(F.lag("i").over(along), F.lit(-2)) != 1).cast("int"))
    parted = once.withColumn("stretch", apart.over(along))
    whole = parted.withColumn("total", F.sum("n_words").over(Window.partitionBy(*document, "stretch"))).where(F.col("total") >= least_words)
    # a window of enough words has at most that many lines, as each has a word
    upward = Window.partitionBy(*document, "stretch").orderBy("i")

    def shortest(frame: Window) -> Column:
        """Lines from here on, in the order of the frame, until there are words enough; null if there are too few."""
        counts = F.collect_list("n_words").over(frame)
        sums = F.aggregate(
            counts,
            F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines")),
            lambda acc, x: F.when(acc["words"] >= least_words, acc).otherwise(F.struct((acc["words"] + x).alias("words"), (acc["lines"] + 1).alias("lines"))),
        )
        return F.when(sums["words"] >= least_words, sums["lines"])

    ahead = shortest(upward.rowsBetween(0, least_words - 1))
    behind = shortest(Window.partitionBy(*document, "stretch").orderBy(F.desc("i")).rowsBetween(0, least_words - 1))
    sized = stored(whole.select("id", "th", "stretch", "i", "rank", ahead.alias("ahead"), behind.alias("behind")))
    discard(lines, known)

    need = F.greatest(F.coalesce("ahead", F.lit(0)), F.coalesce("behind", F.lit(0)))
    needed = sized.withColumn("need", F.max(need).over(Window.partitionBy(*document, "stretch")))
    level = needed.select("id", "th", "i", "need", "rank").where("need > 0")
    longest = sized.agg(F.max(need)).first()[0] or 0
    levels, half = [level.withColumn("k", F.lit(0))], 1
    while 2 * half <= longest:
        beyond = F.first("rank").over(along.rangeBetween(half, half))
        halves = level.where(F.col("need") >= 2 * half).withColumn("second", beyond).where("second is not null")
        level = ranked(halves.withColumnRenamed("rank", "first"), "first", "second")
        levels.append(level.withColumn("k", F.lit(len(levels))))
        half *= 2
    ranks = levels[0]
    for more in levels[1:]:
        ranks = ranks.unionByName(more)
    ranks = ranks.select("id", "th", "k", F.col("i").alias("at"), F.col("rank"))

    forward = sized.where("ahead is not null").select("id", "th", F.col("i").alias("start"), F.col("ahead").alias("size"))
    backward = sized.where("behind is not null").select("id", "th", (F.col("i") - F.col("behind") + 1).alias("start"), F.col("behind").alias("size"))
    k = F.floor(F.log2("size") + 1e-9).cast("int")
    windows = forward.union(backward).distinct().withColumn("k", k)
    last = F.col("start") + F.col("size") - F.pow(F.lit(2), F.col("k")).cast("int")
    windows = windows.withColumn("last", last)
    heads = windows.join(ranks.withColumnsRenamed({"at": "start", "rank": "head"}), ["id", "th", "k", "start"])
    named = stored(heads.join(ranks.withColumnsRenamed({"at": "last", "rank": "tail"}), ["id", "th", "k", "last"]).select("id", "th", "start", "size", "head", "tail"))
    intervals = stored(
        named.groupBy("size", "head", "tail")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "th", "start")).alias("earliest"))
        .where("n > 1")
        .drop("n")
    )
    later = named.join(intervals, ["size", "head", "tail"]).where(F.struct("id", "th", "start") > F.col("earliest"))
    spans = later.groupBy("id", "th").agg(F.collect_set(F.struct("start", "size")).alias("spans"))
    numbers = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1)))
    return spans.select("id", "th", F.array_distinct(numbers).alias("lines"))


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", least_words: int = 50) -> DataFrame:
    """``docs`` with the later copies of repeated line runs deleted from ``text``; columns n_lines and n_deleted added.

    The earliest copy of a run stays. Every row stays; one whose lines all go has an empty text. A null text stays
    null and has no lines. Rows that are equal in id and text are one document, and get the same text; ids are of any type
    that Spark can order, and null ids come before all others. Columns of the input keep their names and order;
    the two added come last, with underscores before their names if those are taken.
    """
    found = stored(repeated_lines(docs, id_column, least_words))
    names = {n: free_name(docs, f"{n}_of") for n in ("id", "th", "lines")}
    # the same join at every size: the texts are shuffled once, and no table is sent to all tasks
    found = found.select(*(F.col(n).alias(v) for n, v in names.items())).hint("merge")
    same = (key_of(docs, id_column) == F.col(names["id"])) & (F.xxhash64(docs["text"]) == F.col(names["th"]))
    joined = docs.join(found, same, "left")
    units, gone = line_units(docs["text"]), F.col(names["lines"])
    left = F.array_except(F.sequence(F.lit(0), F.size(units) - 1), gone)
    text = F.when(gone.isNull(), docs["text"]).otherwise(F.array_join(F.transform(left, lambda n: F.get(units, n)), "\n"))
    size = F.when(F.trim(F.coalesce(docs["text"], F.lit(""))) == "", 0).otherwise(F.size(units)).cast("long")
    columns = [text.alias("text") if c == "text" else docs[c] for c in docs.columns]
    count = F.coalesce(F.size(gone), F.lit(0)).cast("long")
    return joined.select(*columns, size.alias(free_name(docs, "n_lines")), count.alias(free_name(docs, "n_deleted")))


def line_dedup_sql(documents: str = "documents", least_words: int = 50) -> str:
    """DuckDB SQL for doc_id, text, n_lines, n_deleted, by comparing the windows' texts; ids must be unique."""
    return f"""
    with raw as (select doc_id, text, string_split(coalesce(text, ''), chr(10)) as parts from {documents}),
    numbered as (
      select doc_id, n, part, regexp_extract_all(part, '[^\\x20\\x09-\\x0D]+') as w
      from (select doc_id, generate_subscripts(parts, 1) as n, unnest(parts) as part from raw)),
    placed as (
      select *, greatest(sum(case when len(w) > 0 then 1 else 0 end) over (partition by doc_id order by n) - 1, -1) as pos from numbered),
    lines as (
      select doc_id, pos, string_agg(part, chr(10) order by n) as unit, string_agg(array_to_string(w, ' '), '' order by n) as line, sum(len(w)) as words
      from placed group by doc_id, pos),
    real as (select *, sum(words) over (partition by doc_id order by pos) as upto from lines where words > 0),
    ends as (
      select a.doc_id, a.pos as start, min(b.pos) as stop from real a join real b on a.doc_id = b.doc_id and b.pos >= a.pos
        and b.upto - a.upto + a.words >= {least_words} and b.pos < a.pos + {least_words} group by 1, 2
      union
      select b.doc_id, max(a.pos) as start, b.pos as stop from real a join real b on a.doc_id = b.doc_id and b.pos >= a.pos
        and b.upto - a.upto + a.words >= {least_words} and b.pos < a.pos + {least_words} group by b.doc_id, b.pos),
    windows as (
      select e.doc_id, e.start, e.stop, string_agg(l.line, chr(10) order by l.pos) as win
      from ends e join real l on l.doc_id = e.doc_id and l.pos between e.start and e.stop group by 1, 2, 3),
    firsts as (select win, min((doc_id, start)) as earliest from windows group by win),
    gone as (
      select distinct w.doc_id, r.pos from windows w join firsts f on f.win = w.win and (w.doc_id, w.start) > f.earliest
      join real r on r.doc_id = w.doc_id and r.pos between w.start and w.stop),
    kept as (
      select l.doc_id, string_agg(l.unit, chr(10) order by l.pos) filter (where g.pos is null) as text, count(g.pos) as n_deleted, count(*) as n_lines
      from lines l left join gone g on g.doc_id = l.doc_id and g.pos = l.pos group by l.doc_id)
    select d.doc_id, case when d.text is null then null when k.n_deleted = 0 then d.text else coalesce(k.text, '') end as text,
      case when trim(coalesce(d.text, '')) = '' then 0 else k.n_lines end as n_lines, k.n_deleted
    from {documents} d join kept k using (doc_id)
    """
