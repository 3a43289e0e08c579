"""Mixing sources to target weights along a curriculum.

Every source has a schedule, its weight as a piecewise linear function of training time from 0 to 1.
The integral of the schedule is the source's share of all tokens, capped at `most` times what the
source holds; the excess goes to the other sources by weight until none is above its cap.

A source is gone through as often as its target holds it whole; of the last, partial pass, documents
are chosen whole. Sizes decide in which of three levels a document competes: what the choice among
large documents is off by is made up for among the smaller ones, so a target is met to within about
half of a small document however large others are. A document's copies get positions in training
time: the tokens of a source are put in a hashed order, pass by pass, and a token's position is the
time by which the source's cumulative demand, the running integral of its schedule, has come to it.
Documents are then range-sorted by position.

Running totals over a source go through bins by hash: totals of bins, one small row each, give the
offsets, and only rows of one bin are summed in order, so a source that holds most rows is spread
over as many tasks as it has bins. Sources are few: more than `MOST_SOURCES` are refused.

Defined results: a null text has size 0; the null source is one source, sorted last; a source of size
0 has target 0 and its documents are not taken; equal rows are counted and taken each by itself; ties
in the order are broken by id, size and copy; an empty table gives no rows. Columns that are not named
are not read, and `mixed` returns them unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import n_words, plainly_named, row_copies, stored, whole

MOST_SOURCES = 100_000
BINS = 1024
#: a document is in the first level of whose share of the source's mean size it is larger
LEVELS = (1.0, 0.125)

Knots = list[tuple[float, float]]


def constant_mix(weight: float) -> Knots:
    return [(0.0, weight), (1.0, weight)]


def integral(knots: Knots) -> float:
    """Of the piecewise linear schedule."""
    if knots[0][0] != 0 or knots[-1][0] != 1 or any(a[0] >= b[0] for a, b in zip(knots, knots[1:])) or any(w < 0 for _, w in knots):
        raise ValueError("a schedule needs rising times from 0 to 1 and weights of 0 or more")
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))


def targets(sizes: list[int], weights: list[float], most: float) -> list[float]:
    """What each source gives: shares of the sum of sizes by weight, none above `most` sizes."""
    goal, left, capped = float(sum(sizes)), set(range(len(sizes))), {}
    while left:
        weight = sum(weights[i] for i in left)
        rest = goal - sum(capped.values())
        share = {i: rest * weights[i] / weight if weight else 0.0 for i in left}
        above = {i for i in left if share[i] > most * sizes[i]}
        if not above:
            return [capped.get(i, share.get(i, 0.0)) for i in range(len(sizes))]
        capped |= {i: float(most * sizes[i]) for i in above}
        left -= above
    return [capped.get(i, 0.0) for i in range(len(sizes))]


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    documents: int
    target: float
    knots: Knots

    @property
    def passes(self) -> int:
        return int(self.target // self.size) if self.size else 0

    @property
    def rest(self) -> float:
        return self.target - self.passes * self.size


def sources_of(sized: DataFrame, schedule: Callable[[int, str | None], Knots], most: float) -> list[Source]:
    """The sources by code point, null last. `schedule` gives a source's knots from its place and name."""
    held = sized.groupBy("_source").agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(held) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    held.sort(key=lambda r: (r["_source"] is None, r["_source"] or ""))
    knots = [schedule(i, r["_source"]) for i, r in enumerate(held)]
    goals = targets([r["size"] for r in held], [integral(k) for k in knots], most)
    return [Source(r["_source"], r["size"], r["n"], t, k) for r, t, k in zip(held, goals, knots)]


def _running(rows: DataFrame, groups: list[str], order: list[str], size: str, out: str) -> DataFrame:
    """Adds the sum of `size` over the rows before within a group, in the order of bin and `order`."""
    bins = rows.groupBy(*groups, "_bin").agg(F.sum(size).alias("_total"))
    earlier = Window.partitionBy(*groups).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bins.select(*(F.col(g).alias(f"_of{g}") for g in groups), F.col("_bin").alias("_of_bin"), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    same = F.col("_bin") == F.col("_of_bin")
    for g in groups:
        same &= F.col(g).eqNullSafe(F.col(f"_of{g}"))
    inside = Window.partitionBy(*groups, "_bin").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    joined = summed.join(offsets, same).withColumn(out, F.col("_offset") + F.col("_inside"))
    return joined.drop("_inside", "_offset", "_of_bin", *(f"_of{g}" for g in groups))


def _by_source(spark, sources: list[Source], columns: dict[str, list], schema: str) -> DataFrame:
    """A small table of values by source: bounded by MOST_SOURCES rows."""
    rows = list(zip([s.name for s in sources], *columns.values()))
    return F.broadcast(spark.createDataFrame(rows, f"_of_source string, {schema}"))


def _chosen(sized: DataFrame, sources: list[Source]) -> DataFrame:
    """Adds `_copies`, how often the mix takes the document."""
    spark = sized.sparkSession
    means = _by_source(spark, sources, {"mean": [s.size / s.documents for s in sources]}, "_mean double")
    match = F.col("_source").eqNullSafe(F.col("_of_source"))
    level = F.lit(len(LEVELS))
    for i, share in reversed(list(enumerate(LEVELS))):
        level = F.when(F.col("_size") > share * F.col("_mean"), i).otherwise(level)
    levelled = sized.join(means, match).withColumn("_level", level.cast("int")).drop("_of_source", "_mean")
    placed = stored(_running(levelled, ["_source", "_level"], ["_hash", "_id", "_size", "_copy"], "_size", "_before"), "mix-places")
    middle = F.col("_before") + F.col("_size") / 2
    held = {(r["_source"], r["_level"]): r["n"] for r in placed.groupBy("_source", "_level").agg(F.sum("_size").alias("n")).collect()}
    goals: list[list[float]] = []
    owed = [0.0] * len(sources)
    for i in range(len(LEVELS) + 1):
        size = [held.get((s.name, i), 0) for s in sources]
        last = i == len(LEVELS)
        # the share of the level, and what levels of larger documents are off by
        goal = [min(max((s.rest / s.size if s.size else 0.0) * n + o, 0.0), float(n)) for s, n, o in zip(sources, size, owed)]
        goals.append(goal)
        if last:
            break
        table = _by_source(spark, sources, {"goal": goal}, "_goal double")
        taken = placed.where(F.col("_level") == i).join(table, match).where(middle <= F.col("_goal"))
        got = {r["_source"]: r["n"] for r in taken.groupBy("_source").agg(F.sum("_size").alias("n")).collect()}
        owed = [o + (s.rest / s.size if s.size else 0.0) * n - got.get(s.name, 0) for s, n, o in zip(sources, size, owed)]
    each = {"passes": [s.passes for s in sources], "goals": [list(g) for g in zip(*goals)]}
    table = _by_source(spark, sources, each, "_passes int, _goals array<double>")
    once_more = (middle <= F.get("_goals", F.col("_level"))) & (F.col("_size") > 0)
    copies = F.when(F.col("_size") > 0, F.col("_passes") + once_more.cast("int")).otherwise(F.lit(0))
    return placed.join(table, match).withColumn("_copies", copies).drop("_of_source", "_passes", "_goals", "_level", "_before")


def _segments(knots: Knots) -> list[tuple[float, float, float, float]]:
    """Start, cumulative demand there, weight there and slope of each piece; demand is 1 in all."""
    whole_area, area, out = integral(knots), 0.0, []
    for (t, w), (t1, w1) in zip(knots, knots[1:]):
        out.append((t, area, w / whole_area, (w1 - w) / (t1 - t) / whole_area))
        area += (t1 - t) * (w + w1) / 2 / whole_area
    return out


def _inverse(pieces: Column, demand: Column) -> Column:
    """The time by which the cumulative demand has come to `demand`."""

    def within(p: Column) -> Column:
        more = demand - p["area"]
        root = p["weight"] + F.sqrt(F.greatest(p["weight"] * p["weight"] + 2 * more * p["slope"], F.lit(0.0)))
        return F.when(more <= 0, p["start"]).otherwise(p["start"] + 2 * more / F.greatest(root, F.lit(1e-300)))

    reached = F.filter(pieces, lambda p: p["area"] <= demand)
    return F.least(within(F.element_at(reached, -1)), F.lit(1.0))


def curriculum(
    docs: DataFrame,
    schedule: Callable[[int, str | None], Knots],
    most: float = 3.0,
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
    seed: int = 0,
    key: Column | None = None,
) -> DataFrame:
    """One row for each document: `_id`, `_source`, `_key`, `_copy` (among equal rows), `_size`, `_source_size`,
    `_target`, `_copies`, and `_positions`, the training positions of its copies, each at the middle
    of its tokens. `size` gives a document's size, words of `text` unless said otherwise; `key` more
    to tell documents apart by."""
    spark = docs.sparkSession
    size = n_words(F.col("text")) if size is None else size
    keyed = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"), size.cast("long").alias("_size"),
        (F.lit(0) if key is None else key).alias("_key"),
    )
    hashed = row_copies(keyed, "_copy").withColumn("_hash", F.xxhash64(F.lit(seed), "_id", "_key", "_size", "_copy"))
    sized = stored(hashed.withColumn("_bin", F.pmod(F.col("_hash"), F.lit(BINS)).cast("int")), "mix-sizes")
    sources = sources_of(sized, schedule, most)
    chosen = stored(_chosen(sized, sources), "mix-chosen")
    copies = chosen.where("_copies > 0").withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    # another hash than the one that chose, so that positions do not follow sizes
    copies = copies.withColumn("_order", F.xxhash64(F.lit(seed + 1), "_hash", "_pass"))
    spread = copies.withColumn("_bin", (F.col("_pass") * BINS + F.pmod("_order", F.lit(BINS))).cast("int"))
    placed = _running(spread, ["_source"], ["_order", "_id", "_size", "_copy"], "_size", "_before")
    totals = {r["_source"]: r["n"] for r in chosen.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_copies")).alias("n")).collect()}
    pieces = [_segments(s.knots) if integral(s.knots) else [(0.0, 0.0, 1.0, 0.0)] for s in sources]
    table = _by_source(
        spark, sources, {"total": [totals.get(s.name, 0) for s in sources], "pieces": pieces},
        "_total bigint, _pieces array<struct<start:double,area:double,weight:double,slope:double>>",
    )
    match = F.col("_source").eqNullSafe(F.col("_of_source"))
    demand = (F.col("_before") + F.col("_size") / 2) / F.col("_total")
    timed = placed.join(table, match).withColumn("_position", _inverse(F.col("_pieces"), demand))
    names = ["_id", "_source", "_key", "_size", "_copy"]
    positions = timed.groupBy(*(F.col(n).alias(f"_of{n}") for n in names)).agg(F.sort_array(F.collect_list("_position")).alias("_positions"))
    about = _by_source(
        spark, sources, {"size": [s.size for s in sources], "target": [s.target for s in sources]}, "_source_size bigint, _target double"
    )
    same = F.lit(True)
    for name in names:
        same &= F.col(name).eqNullSafe(F.col(f"_of{name}"))
    joined = chosen.join(positions, same, "left").select(*names, "_copies", "_positions")
    return joined.join(about, match).drop("_of_source")


def by_position(rows: DataFrame, position: str, *ties: str) -> DataFrame:
    """Range-sorted by position."""
    return rows.orderBy(F.col(position).asc_nulls_last(), *ties)


def _row_key(docs: DataFrame, text_col: str) -> Column:
    """Hash of all columns: 128 bits of the text, and of the others, with their nulls, as JSON."""
    exact = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    written = {"ignoreNullFields": "false", "timestampFormat": exact + "XXX", "timestampNTZFormat": exact}
    others = F.struct(*(F.col(c) for c in docs.columns if c != text_col), F.col(text_col).isNull().alias("_no_text"))
    return F.md5(F.concat(F.md5(whole(text_col)), F.to_json(others, written)))


def mixed(
    docs: DataFrame,
    schedule: Callable[[int, str | None], Knots],
    most: float = 3.0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    seed: int = 0,
) -> DataFrame:
    """The documents as training takes them: every column, as many rows as copies, in the order of
    their positions."""
    docs, named, back = plainly_named(docs)
    id_col, source_col, text_col = named[id_col], named[source_col], named[text_col]
    key = _row_key(docs, text_col)
    plan = curriculum(docs, schedule, most, id_col, source_col, n_words(F.col(text_col)), seed, key)
    # rows that are equal in every column share all their positions
    merged = plan.where("_copies > 0").groupBy("_id", "_source", "_key").agg(
        F.count(F.lit(1)).alias("_rows"), F.flatten(F.collect_list("_positions")).alias("_positions")
    )
    signed = docs.withColumn("_md5", key)
    same = (signed["_md5"] == merged["_key"]) & signed[id_col].eqNullSafe(merged["_id"]) & signed[source_col].eqNullSafe(merged["_source"])
    repeated = plan.where("_copy > 1")
    if not repeated.isEmpty():
        signed = signed.dropDuplicates([id_col, source_col, "_md5"])
    taken = signed.join(merged, same).withColumn("_position", F.explode("_positions"))
    return by_position(taken, "_position", "_md5").select(*back)
