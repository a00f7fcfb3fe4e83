"""Counting many conditions over a table in one pass.

A probe is one number to count plus the finding it turns into. All probes of a table compile to one
global aggregate: a single scan, partial sums per task, one row out. The row is then turned on its
side into one line per probe, so metrics and findings are ordinary tables.

A wide table has hundreds of probes that are one test on many columns. One aggregate each would make a
plan that grows with the columns and that no code generator takes. There the cells of a kind stand in one
array, the test is written once over its elements, and the positions that hold are counted as rows of a
grouped aggregate: again one scan, and one row per task and position shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import quoted, ref
from ..model import INFO, ISSUE_COLUMNS, issue, local_table

N_ROWS = "n_rows"
# Counted conditions beyond which cells are tested in blocks: where Spark gives up code generation as well.
WIDE = 100


@dataclass(frozen=True)
class CellTest:
    """A condition on the cells of one or two columns, the same expression for all of one ``kind``."""

    kind: tuple
    cells: tuple[str, ...]
    test: Callable[..., Column]

    def condition(self) -> Column:
        return self.test(*[ref(name) for name in self.cells])


@dataclass(frozen=True)
class Probe:
    step: str
    stage: str
    check_name: str
    severity: str
    message: str  # {n} stands for the count
    column_name: str | None = None
    condition: Column | None = None  # rows to count
    cell_test: CellTest | None = None  # or a test shared with other columns
    count_name: str | None = None  # or a column that already holds the count; neither: no count
    detail: str | None = None
    empty_table: bool = False  # fires when the table has no rows
    pass_check: str | None = None  # INFO finding when nothing was counted
    pass_message: str | None = None
    finding: bool = True  # False: a metric only

    @property
    def conditional(self) -> bool:
        return self.condition is not None or self.cell_test is not None

    def counted_as(self, position: int) -> str | None:
        return f"p{position}" if self.conditional else self.count_name

    def rows(self) -> Column:
        return self.condition if self.cell_test is None else self.cell_test.condition()


def probe_aggregates(probes: Sequence[Probe]) -> list[Column]:
    counted = [F.count_if(probe.rows()).alias(probe.counted_as(i)) for i, probe in enumerate(probes) if probe.conditional]
    return [F.count(F.lit(1)).alias(N_ROWS), *counted]


def is_wide(probes: Sequence[Probe]) -> bool:
    return sum(probe.conditional for probe in probes) > WIDE


def map_cells(kind_cells: Sequence[tuple[str, ...]], test: Callable[..., Column]) -> Column:
    """``test`` over many columns, or pairs of columns, of the same types: an array in their order."""
    sides = [F.expr(f"array({', '.join(quoted(name) for name in side)})") for side in zip(*kind_cells)]
    return F.transform(sides[0], lambda x: test(x)) if len(sides) == 1 else F.zip_with(*sides, lambda x, y: test(x, y))


def block_places(probes: Sequence[Probe]) -> tuple[dict[tuple, list[int]], dict[int, int]]:
    """Probes by kind of test, and the place of each probe among the flags; those that count nothing come last."""
    kinds: dict[tuple, list[int]] = {}
    for i, probe in enumerate(probes):
        if probe.conditional:
            kinds.setdefault(() if probe.cell_test is None else probe.cell_test.kind, []).append(i)
    silent = [i for i, probe in enumerate(probes) if not probe.conditional]
    order = [i for members in [*kinds.values(), silent] for i in members]
    return kinds, {i: at for at, i in enumerate(order)}


def block_counts(df: DataFrame, probes: Sequence[Probe]) -> DataFrame:
    """Count ``n`` by place ``at`` of the probes; the rows of the table stand at -1."""
    kinds, places = block_places(probes)
    flags = [
        map_cells([probes[i].cell_test.cells for i in members], probes[members[0]].cell_test.test)
        if kind
        else F.array(*[probes[i].condition for i in members])
        for kind, members in kinds.items()
    ]
    held = F.filter(F.transform(F.concat(*flags), lambda flag, at: F.when(flag, at)), lambda at: at.isNotNull())
    # outer: a plain explode has the optimizer test the array's size first, which builds it twice; it is never empty
    hits = df.select(F.explode_outer(F.concat(F.array(F.lit(-1)), held)).alias("at"), F.lit(1).cast("long").alias("n"))
    # a zero for each place, so that one nothing falls on is there as well
    zeros = df.sparkSession.range(-1, len(places)).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("long").alias("n"))
    return hits.unionAll(zeros).groupBy("at").agg(F.sum("n").alias("n"))


def probe_counts(df: DataFrame, probes: Sequence[Probe]) -> dict[str, Any]:
    """All counts of a table by name: as many numbers as there are probes."""
    if not is_wide(probes):
        return df.agg(*probe_aggregates(probes)).first().asDict()
    _, places = block_places(probes)
    by_place = dict(block_counts(df, probes).collect())
    found = {probe.counted_as(i): by_place[places[i]] for i, probe in enumerate(probes) if probe.conditional}
    return {N_ROWS: by_place[-1], **found}


LINE_SCHEMA = (
    "seq int, step_name string, stage string, check_name string, severity string, message string, column_name string, "
    "detail string, pass_check string, pass_message string, finding boolean, counted boolean"
)


def probe_lines(counts: DataFrame, probes: Sequence[Probe]) -> DataFrame:
    """One line per probe: the one-row table of counts unfolded beside what each count stands for."""
    numbers = []
    for i, probe in enumerate(probes):
        name = probe.counted_as(i)
        if probe.empty_table:
            numbers.append((F.col(N_ROWS) == 0).cast("long"))
        else:
            numbers.append(F.lit(None).cast("long") if name is None else F.col(name))
    total = F.col(N_ROWS) if N_ROWS in counts.columns else F.lit(None).cast("long").alias(N_ROWS)
    unfolded = counts.select(total, F.posexplode(F.array(*numbers)).alias("seq", "failing_rows"))
    return unfolded.join(_texts(counts, probes, range(len(probes))), "seq")


def _texts(df: DataFrame, probes: Sequence[Probe], seqs: Sequence[int]) -> DataFrame:
    texts = [
        (seq, probe.step, probe.stage, probe.check_name, probe.severity, probe.message, probe.column_name,
         probe.detail, probe.pass_check, probe.pass_message, probe.finding, not probe.empty_table)
        for seq, probe in zip(seqs, probes)
    ]
    return local_table(df.sparkSession, texts, LINE_SCHEMA)


def run_probes(df: DataFrame, probes: Sequence[Probe]) -> DataFrame:
    if not is_wide(probes):
        return probe_lines(df.agg(*probe_aggregates(probes)), probes)
    _, places = block_places(probes)
    counted = block_counts(df, probes)
    # one row with as many entries as there are probes, so that the total stands beside each
    row = counted.agg(F.max(F.when(F.col("at") == -1, F.col("n"))).alias(N_ROWS), F.collect_list(F.struct("at", "n")).alias("c"))
    unfolded = row.select(N_ROWS, F.inline("c")).withColumnsRenamed({"at": "seq", "n": "failing_rows"})
    lines = unfolded.join(_texts(df, probes, [places[i] for i in range(len(probes))]), "seq")
    silent = F.when(~F.col("counted"), (F.col(N_ROWS) == 0).cast("long"))
    counts = sum(probe.conditional for probe in probes)
    return lines.withColumn("failing_rows", F.when(F.col("seq") < counts, F.col("failing_rows")).otherwise(silent))


def probe_issues(lines: DataFrame, dataset_id: str) -> DataFrame:
    """Findings of the probes that fired, plus the INFO of those that passed and carry one."""
    n = F.col("failing_rows")
    fired = n.isNull() | (n > 0)
    passed = F.col("pass_check").isNotNull() & ~fired
    found = lines.filter(F.col("finding") & (fired | passed)).select(
        F.lit(dataset_id).alias("dataset_id"),
        "stage",
        F.when(fired, F.col("check_name")).otherwise(F.col("pass_check")).alias("check_name"),
        F.when(fired, F.col("severity")).otherwise(F.lit(INFO)).alias("severity"),
        F.when(fired, F.replace("message", F.lit("{n}"), F.coalesce(n.cast("string"), F.lit(""))))
        .otherwise(F.col("pass_message"))
        .alias("message"),
        "column_name",
        F.when(fired & F.col("counted"), n).alias("row_count"),
        F.lit(None).cast("string").alias("output_path"),
    )
    return found.select(*ISSUE_COLUMNS)


def probe_findings(counts: Mapping[str, int], probes: Sequence[Probe], dataset_id: str) -> list[tuple[str, tuple]]:
    """Step and issue row of every probe that fired, from counts already at hand."""
    found = []
    for i, probe in enumerate(probes):
        name = probe.counted_as(i)
        n = int(counts[N_ROWS] == 0) if probe.empty_table else None if name is None else counts[name]
        if probe.finding and (n is None or n > 0):
            message = probe.message.replace("{n}", "" if n is None else str(n))
            shown = None if probe.empty_table else n
            row = issue(
                dataset_id, probe.stage, probe.check_name, probe.severity, message, probe.column_name, shown
            )
            found.append((probe.step, row))
    return found
