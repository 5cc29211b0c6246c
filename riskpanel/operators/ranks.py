"""Exact order statistics of many columns without sorting or shuffling the rows.

Every step is one aggregate over the table. The first counts each column. While
too many values could be the wanted one, a sampling step proposes pivots around
the wanted rank, and a counting step counts, over all rows, the values below and
at each pivot. The sample only proposes; the counts decide, and a poor proposal
costs another round, never a wrong value. A round reads the columns twice, moves
a bounded sample and a few counters, and leaves less than a hundredth of the
candidates: 10^12 rows need three rounds. A pivot is a value of the column and
is settled by its own count, so repeated values cannot stall the search. The
last step takes the exact rank among the candidates left.

Whole numbers and decimals that no double holds are searched digit by digit.

``gather_rows`` bounds the candidates of all searches together, as the last
step holds them in one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpanel.functions.columns import clean_number, ref
from riskpanel.functions.digits import beyond_double, digits, from_digits, may_be_beyond

GATHER_ROWS = 1_000_000
SAMPLE_ROWS = 1_000_000
GRID = 4_000
ACCURACY = 40_000
PARTS = 1 << 20


@dataclass(frozen=True)
class ColumnCount:
    """Rows of the table, the column's non-null count and bounds, and any extra results.

    The bounds of a column with values that no double holds (``exact``) are whole
    numbers or decimals.
    """

    rows: int
    present: int
    low: float | int | Decimal | None
    high: float | int | Decimal | None
    extra: dict
    exact: bool = False


@dataclass
class _Search:
    """Candidates for one rank: the finite values strictly between ``low`` and ``high``."""

    column: str
    asked: int
    rank: int
    inside: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    value: float | None = None

    @property
    def interval(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high

    def pivots(self, grid: list[float], sample_rows: int) -> set[float]:
        """Sampled values next to the wanted rank, four standard errors to each side."""
        if not grid:
            return set()
        share = (self.rank - self.below) / max(self.inside - 1, 1)
        size = min(sample_rows, self.inside)
        margin = math.ceil(4 * math.sqrt(share * (1 - share) / size) * GRID) + 1
        slot = int(share * GRID)
        return {grid[min(max(i, 0), GRID)]
                for i in (slot - margin, slot, slot + 1, slot + 1 + margin)}

    def settle(self, edges: list[tuple[float, int, int]]) -> None:
        """Narrow by ascending (pivot, values below it, values up to it)."""
        end = self.below + self.inside
        for x, below, upto in edges:
            if below <= self.rank < upto:
                self.value = x
                return
            if upto <= self.rank and x > self.low:
                self.low, self.below = x, upto
            elif self.rank < below and x < self.high:
                self.high, end = x, below
                break
        self.inside = end - self.below


def long_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (slot, value): every value of every column, NULLs included.

    Grouped by slot, one set of aggregates serves all columns. It stays small
    enough to compile, which the same aggregates side by side for many columns
    do not.
    """
    cells = [x for i, c in enumerate(columns)
             for x in (F.lit(i), clean_number(df, c) + F.lit(0.0))]  # minus zero is zero
    return df.select(F.stack(F.lit(len(columns)), *cells).alias("slot", "value"))


def count_columns(df: DataFrame, columns: list[str],
                  extra: list[Column] | None = None) -> dict[str, ColumnCount]:
    """Counts and bounds of all columns in one pass, with any extra aggregates of the
    ``value`` and ``slot`` of :func:`long_numbers`."""
    if not columns:
        return {}
    found = {r["slot"]: r.asDict() for r in long_numbers(df, columns).groupBy("slot").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("present"),
        F.min("value").alias("low"), F.max("value").alias("high"), *(extra or [])).collect()}
    empty = {"rows": 0, "present": 0, "low": None, "high": None}
    counts = {}
    for i, c in enumerate(columns):
        row = found.get(i, {})
        counts[c] = ColumnCount(*[row.get(k, v) for k, v in empty.items()],
                                {k: v for k, v in row.items() if k not in empty and k != "slot"})
    return _with_exact_bounds(df, counts)


def _with_exact_bounds(df: DataFrame, counts: dict[str, ColumnCount]) -> dict[str, ColumnCount]:
    """The counts with the bounds of columns that need it in their own type."""
    asked = [c for c, n in counts.items() if n.present and may_be_beyond(
        df.schema[c].dataType, max(abs(n.low), abs(n.high)))]
    if not asked:
        return counts
    row = df.agg(*[f(ref(c)).alias(f"{name}{i}") for i, c in enumerate(asked)
                   for name, f in (("lo", F.min), ("hi", F.max))]).first()
    out = dict(counts)
    for i, c in enumerate(asked):
        low, high = row[f"lo{i}"], row[f"hi{i}"]
        if beyond_double(df.schema[c].dataType, low, high):
            out[c] = replace(counts[c], low=low, high=high, exact=True)
    return out


def values_at_ranks(df: DataFrame, counts: dict[str, ColumnCount], ranks: dict[str, list[int]],
                    gather_rows: int = GATHER_ROWS,
                    sample_rows: int = SAMPLE_ROWS) -> dict[str, dict[int, float | None]]:
    """The value at each 0-based rank of each column's ascending non-null values.

    A rank at or past the number of non-null values gives None: NULLs sort last.
    """
    found: dict[str, dict[int, float | None]] = {c: {} for c in ranks}
    asked: dict[str, list[int]] = {}
    for column, wanted in ranks.items():
        count = counts[column]
        for rank in sorted(set(wanted)):
            if rank < 0 or rank >= count.present:
                found[column][rank] = None
            elif rank in (0, count.present - 1):
                found[column][rank] = count.low if rank == 0 else count.high
            else:
                asked.setdefault(column, []).append(rank)
    exact = {c: asked.pop(c) for c in list(asked) if counts[c].exact}
    if exact:
        for c, values in _exact_values(df, counts, exact, gather_rows, sample_rows).items():
            found[c].update(values)
    if not asked:
        return found
    names = {c: f"c{i}" for i, c in enumerate(asked)}
    # adding zero turns minus zero into zero
    numbers = df.select(*[(clean_number(df, c) + F.lit(0.0)).alias(names[c]) for c in asked])
    searches = [s for c in asked for s in _finite_searches(numbers, names[c], c, counts[c],
                                                           asked[c])]
    numbers = numbers.select(*[F.when(F.abs(x) < math.inf, F.col(x)).alias(x)
                               for x in names.values()])
    stalled = 0
    while True:
        unsettled = [s for s in searches if s.value is None]
        limit = max(gather_rows // max(len({s.interval for s in unsettled}), 1), 1)
        wide = [s for s in unsettled if s.inside > limit]
        if not wide:
            break
        before = [(s.value, s.inside) for s in searches]
        _narrow(numbers, names, wide, searches, sample_rows)
        # a sample may propose nothing once, by chance; not again and again
        stalled = stalled + 1 if before == [(s.value, s.inside) for s in searches] else 0
        if stalled == 20:
            raise RuntimeError("the rank search makes no progress")
    _gather(numbers, names, [s for s in searches if s.value is None])
    for s in searches:
        found[s.column][s.asked] = s.value
    return found


def _exact_values(df: DataFrame, counts: dict[str, ColumnCount], ranks: dict[str, list[int]],
                  gather_rows: int, sample_rows: int) -> dict[str, dict[int, int | Decimal]]:
    """Values at ranks by their digits, each of which a double holds.

    The first digit at each rank is found like any value. Among the rows that have it,
    the next digit is found at the rank less the rows with a smaller one, and so on.
    """
    split = {c: digits(df, c) for c in ranks}
    # an open search: column, first digits found so far, and its ranks (asked, rest)
    todo = [(c, (), [(r, r) for r in wanted]) for c, wanted in ranks.items()]
    found: dict[str, dict[int, int | Decimal]] = {c: {} for c in ranks}
    while todo:
        columns = []
        for c, known, _ in todo:
            same = F.lit(True)
            for d, value in zip(split[c], known):
                same = same & (d == F.lit(value))
            columns.append(F.when(same, split[c][len(known)]))
        names = [f"d{i}" for i in range(len(todo))]
        level = df.select(*[d.alias(n) for n, d in zip(names, columns)])
        level_counts = count_columns(level, names)
        values = values_at_ranks(level, level_counts, {
            n: [rest for _, rest in wanted] for n, (_, _, wanted) in zip(names, todo)},
            gather_rows, sample_rows)
        groups = []
        for n, (c, known, wanted) in zip(names, todo):
            by_value: dict[float, list] = {}
            for asked, rest in wanted:
                by_value.setdefault(values[n][rest], []).append((asked, rest))
            groups += [(n, c, (*known, v), rest) for v, rest in by_value.items()]
        below = level.agg(*[F.count_if(F.col(n) < F.lit(known[-1])).alias(f"b{i}")
                            for i, (n, _, known, _) in enumerate(groups)]).first()
        todo = []
        for i, (_, c, known, wanted) in enumerate(groups):
            if len(known) == len(split[c]):
                value = from_digits(df.schema[c].dataType, known)
                found[c].update((asked, value) for asked, _ in wanted)
            else:
                todo.append((c, known, [(asked, rest - below[f"b{i}"]) for asked, rest in wanted]))
    return found


def _finite_searches(numbers: DataFrame, name: str, column: str, count: ColumnCount,
                     ranks: list[int]) -> list[_Search]:
    """Searches among the finite values; ranks that fall on infinities are settled."""
    first, finite = 0, count.present
    if math.isinf(count.low) or math.isinf(count.high):
        row = numbers.agg(F.count_if(F.col(name) == -math.inf).alias("low"),
                          F.count_if(F.col(name) == math.inf).alias("high")).first()
        first, finite = row["low"], count.present - row["low"] - row["high"]
    searches = []
    for rank in ranks:
        search = _Search(column, rank, rank - first, finite)
        if search.rank < 0:
            search.value = -math.inf
        elif search.rank >= finite:
            search.value = math.inf
        searches.append(search)
    return searches


def shares_sql(steps: int) -> str:
    """Evenly spaced shares 0..1 as one foldable array literal."""
    return ("cast(split('" + ",".join(repr(i / steps) for i in range(steps + 1))
            + "', ',') as array<double>)")


def _cut(numbers: DataFrame, names: dict[str, str],
         edges: dict[str, set[float]]) -> tuple[DataFrame, dict[str, list[float]]]:
    """Long rows (part, value) of every column, cut at its finite edges, and the edges.

    Part ``i * PARTS + j`` holds the values of column i from edge j up to the next edge.
    """
    columns = list(edges)
    splits = {c: [-math.inf, *sorted(x for x in edges[c] if math.isfinite(x)), math.inf]
              for c in columns}
    cut = [c for c in columns if len(splits[c]) > 2]
    frame = numbers
    if cut:
        frame = Bucketizer(splitsArray=[splits[c] for c in cut],
                           inputCols=[names[c] for c in cut],
                           outputCols=[f"part_{names[c]}" for c in cut]).transform(numbers)
    cells = []
    for i, c in enumerate(columns):
        part = F.col(f"part_{names[c]}") if c in cut else F.lit(0.0)
        cells.append((part + F.lit(float(i * PARTS))).cast("long"))
        cells.append(F.col(names[c]))
    rows = frame.select(F.stack(F.lit(len(columns)), *cells).alias("part", "value"))
    return rows.where("value IS NOT NULL"), splits


def _after(x: float) -> float:
    """The next larger double: values from here on are strictly larger than x."""
    return math.nextafter(x, math.inf)


def _candidates(numbers: DataFrame, names: dict[str, str],
                searches: list[_Search]) -> tuple[DataFrame, dict[tuple, int]]:
    """Long rows (part, value) of the searches' candidates only, and each interval's part."""
    edges: dict[str, set[float]] = {}
    for s in searches:
        start = s.low if s.low == -math.inf else _after(s.low)
        edges.setdefault(s.column, set()).update((start, s.high))
    rows, splits = _cut(numbers, names, edges)
    columns = list(edges)
    parts = {}
    for s in searches:
        start = s.low if s.low == -math.inf else _after(s.low)
        parts[s.interval] = columns.index(s.column) * PARTS + splits[s.column].index(start)
    return rows.where(F.col("part").isin(*parts.values())), parts


def _narrow(numbers: DataFrame, names: dict[str, str], wide: list[_Search],
            searches: list[_Search], sample_rows: int) -> None:
    """One round: sample the candidates of each interval, then place ranks among pivots."""
    rows, parts = _candidates(numbers, names, wide)
    rates = {parts[s.interval]: min(sample_rows / s.inside, 1.0) for s in wide}
    rate = F.create_map(*[F.lit(x) for item in rates.items() for x in item])[F.col("part")]
    grids = {r["part"]: r["grid"] for r in rows.where(F.rand() < rate).groupBy("part").agg(
        F.expr(f"percentile_approx(value, {shares_sql(GRID)}, {ACCURACY})").alias("grid")
    ).collect()}
    pivots: dict[str, set[float]] = {}
    for s in wide:
        near = s.pivots(grids.get(parts[s.interval]), sample_rows)
        if near:
            pivots.setdefault(s.column, set()).update(near)
    if not pivots:
        return
    placed = _place(numbers, names, pivots)
    for s in searches:
        if s.value is None and s.column in placed:
            s.settle(placed[s.column])


def _place(numbers: DataFrame, names: dict[str, str],
           pivots: dict[str, set[float]]) -> dict[str, list[tuple[float, int, int]]]:
    """Exact (pivot, values below, values up to) by counting the parts between pivots."""
    rows, splits = _cut(numbers, names,
                        {c: xs | {_after(x) for x in xs} for c, xs in pivots.items()})
    counted = {r["part"]: r["count"] for r in rows.groupBy("part").count().collect()}
    placed = {}
    for i, c in enumerate(pivots):
        upto, total = {}, 0
        for j, end in enumerate(splits[c][1:]):
            total += counted.get(i * PARTS + j, 0)
            upto[end] = total
        placed[c] = [(x, upto[x], upto[_after(x)]) for x in sorted(pivots[c])]
    return placed


def _gather(numbers: DataFrame, names: dict[str, str], searches: list[_Search]) -> None:
    """One pass over the remaining candidates: each interval's are sorted in one task."""
    if not searches:
        return
    rows, parts = _candidates(numbers, names, searches)
    places: dict[int, list[int]] = {}
    for s in searches:
        places.setdefault(parts[s.interval], []).append(s.rank - s.below)
    wanted = F.create_map(*[x for part, at in places.items()
                            for x in (F.lit(part), F.array(*[F.lit(i) for i in at]))])
    lists = rows.groupBy("part").agg(F.sort_array(F.collect_list("value")).alias("list"))
    picked = lists.select("part", F.transform(wanted[F.col("part")],
                                              lambda i: F.col("list")[i]).alias("values"))
    values = {r["part"]: dict(zip(places[r["part"]], r["values"])) for r in picked.collect()}
    for s in searches:
        s.value = values[parts[s.interval]][s.rank - s.below]
