"""Upsert and slowly-changing history as pure DataFrame functions.

Both split the work so that no step can pile a hot key onto one task:

* source rows are counted by their keys alone, a hash aggregate, and joined to the target as they
  are. A small source is broadcast by size and the target is not shuffled at all; a large one is
  sort-merge joined, where AQE can split skewed *left* partitions of a left outer join (it cannot
  for a full outer join);
* rows to insert are found by an anti join against those target keys that the source has at all: a
  keys-only scan, from which a small source filters the rest before anything is shuffled.

Null keys never match, as in SQL ``MERGE``: such source rows are inserted, such target rows kept.
The source is read several times: hand in a stored table, or one whose rows do not change.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.columns import all_of, any_of, instant, ref, refs
from carelake.operators import intervals

VALID_FROM, VALID_TO, IS_CURRENT = "valid_from", "valid_to", "is_current"
_ROW, _N, _KEY = "__row", "__n", "__k"


def _complete(keys: Sequence[str]) -> Column:
    return all_of(ref(k).isNotNull() for k in keys)


def _counted(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows with complete keys: the keys as __k<i>, the row, and how many rows share them."""
    names = [f"{_KEY}{i}" for i in range(len(keys))]
    keyed = source.where(_complete(keys)).select(
        *[ref(k).alias(n) for k, n in zip(keys, names)], F.struct(*refs(source.columns)).alias(_ROW)
    )
    return keyed.join(keyed.groupBy(*names).agg(F.count(F.lit(1)).alias(_N)), names)


def _known(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target keys that the source has too, as __k<i>."""
    wanted = source.where(_complete(keys)).select(*[ref(k).alias(f"{_KEY}{i}") for i, k in enumerate(keys)])
    return target.select(*[ref(k).alias(f"{_KEY}{i}") for i, k in enumerate(keys)]).join(
        wanted, [f"{_KEY}{i}" for i in range(len(keys))], "left_semi"
    )


def _same_key(keys: Sequence[str]) -> Column:
    return all_of(ref(k) == F.col(f"{_KEY}{i}") for i, k in enumerate(keys))


def _unmatched(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks (null keys included)."""
    return source.join(_known(target, source, keys), _same_key(keys), "left_anti")


def _single_match(what: str) -> Column:
    """A row filter that fails the query when more than one source row claims a key."""
    several = F.raise_error(F.lit(f"{what}: several source rows match one target row")).cast("boolean")
    return F.when(F.coalesce(F.col(_N), F.lit(1)) > 1, several).otherwise(F.lit(True))


def _typed(df: DataFrame, like: DataFrame, column: str) -> Column:
    kind = like.schema[column].dataType
    return ref(column).cast(kind) if column in df.columns else F.lit(None).cast(kind)


def _applied(
    joined: DataFrame,
    added: DataFrame,
    target: DataFrame,
    source: DataFrame,
    update_columns: Sequence[str] | None,
    action_column: str | None,
) -> DataFrame:
    """Target rows, joined with the source row that claims them if any, plus rows to insert."""
    changed = set(source.columns if update_columns is None else update_columns)
    hit = F.col(_N).isNotNull()

    def merged(c: str) -> Column:
        if c not in changed or c not in source.columns:
            return ref(c)
        new = F.col(_ROW).getField(c).cast(target.schema[c].dataType)
        return F.when(hit, new).otherwise(ref(c)).alias(c)

    label = [] if action_column is None else [action_column]
    present = joined.where(_single_match("upsert")).select(
        *[merged(c) for c in target.columns],
        *[F.when(hit, "updated").otherwise("kept").alias(a) for a in label],
    )
    new = added.select(
        *[_typed(source, target, c).alias(c) for c in target.columns],
        *[F.lit("inserted").alias(a) for a in label],
    )
    return present.unionByName(new)


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    action_column: str | None = None,
) -> DataFrame:
    """Rows of ``target`` with matching source rows applied, plus source rows that match nothing.

    A match overwrites ``update_columns`` (all source columns by default) and leaves the others;
    an insert takes every source column. Two source rows for one target row raise an error, as a
    ``MERGE`` does. With no target the source is the result. ``action_column`` adds
    ``inserted`` / ``updated`` / ``kept``.
    """
    if target is None:
        return source.select("*", *([F.lit("inserted").alias(action_column)] if action_column else []))
    _check_columns(target, source)
    joined = target.join(_counted(source, keys), _same_key(keys), "left")
    added = _unmatched(source, target, keys)
    return _applied(joined, added, target, source, update_columns, action_column)


def upsert_where(
    target: DataFrame,
    source: DataFrame,
    condition: str,
    row_id: Sequence[str],
    update_columns: Sequence[str] | None = None,
    action_column: str | None = None,
) -> DataFrame:
    """Upsert on any SQL condition over ``target.`` and ``source.`` columns.

    ``row_id`` names columns that identify one target row; they tell a row matched twice (an
    error) from two rows matched once. Equality terms of the condition become join keys; so do the
    bins of a term like ``source.a BETWEEN target.b AND target.c``. Without either, every pair of
    rows would have to be tried, so such a condition is refused.
    """
    _check_columns(target, source)
    t, s, on = target.alias("target"), source.alias("source"), F.expr(condition)
    if has_equality(condition):
        pairs, lacking = t.join(s, on, "inner"), s.join(t, on, "left_anti")
    elif found := range_term(condition):
        pairs, lacking = _ranged(target, source, on, found)
    else:
        raise ValueError(f"the condition needs a term like target.a = source.b, or one with BETWEEN: {condition}")
    names = [f"{_KEY}{i}" for i in range(len(row_id))]
    claims = pairs.select(
        *[ref(c, "target").alias(n) for c, n in zip(row_id, names)],
        F.struct(*refs(source.columns, "source")).alias(_ROW),
    )
    counts = claims.groupBy(*names).agg(F.count(F.lit(1)).alias(_N))
    same_claim = all_of(F.col(n).eqNullSafe(F.col(f"{n}c")) for n in names)
    claims = claims.join(counts.toDF(*[f"{n}c" for n in names], _N), same_claim).select(*names, _ROW, _N)
    same_row = all_of(ref(c).eqNullSafe(F.col(f"{_KEY}{i}")) for i, c in enumerate(row_id))
    joined = target.join(claims, same_row, "left")
    return _applied(joined, lacking, target, source, update_columns, action_column)


def _ranged(target: DataFrame, source: DataFrame, on: Column, term: tuple[str, str, str, str]) -> tuple[DataFrame, DataFrame]:
    """Pairs that a condition with a range term joins, and source rows that it joins with nothing.
    Values and intervals meet on equal bins; the whole condition is then checked. A value stands in a
    bin of every level, which Spark's size of it does not count, so the join is one that shuffles."""
    value_side, value, low, high = term
    side = {"target": target, "source": source}
    held_side = "source" if value_side == "target" else "target"
    held = intervals.binned_intervals(side[held_side], ref(low), ref(high))
    on_levels = intervals.levels(held)
    values = intervals.binned_values(side[value_side], ref(value), on_levels)
    binned = {value_side: values, held_side: held}
    t, s = binned["target"].alias("target"), binned["source"].hint("merge").alias("source")
    met = all_of(ref(c, "target") == ref(c, "source") for c in (intervals.LEVEL, intervals.BIN)) & on
    # a row stands in several bins, so what has met is found by the rows' values
    names = [f"{_KEY}s{i}" for i in range(len(source.columns))]
    known = t.join(s, met).select(*[ref(c, "source").alias(n) for c, n in zip(source.columns, names)])
    same = all_of(ref(c, "source").eqNullSafe(F.col(n)) for c, n in zip(source.columns, names))
    return t.join(s, met), source.alias("source").join(known, same, "left_anti")


def range_term(condition: str) -> tuple[str, str, str, str] | None:
    """Side, value, low and high of a term ``a.value BETWEEN b.low AND b.high`` over both sides that
    must hold for the whole condition."""
    column = r"(target|source)\.`?(\w+)`?"
    outside = re.sub(r"\([^()]*\)", " ", condition)
    if re.search(r"(?i)\b(or|not|case)\b|[()]", outside):
        return None
    for m in re.finditer(rf"(?i)(?<![\w.+*/-]){column}\s+between\s+{column}\s+and\s+{column}(?=\s*(?:$|\band\b))", outside):
        if re.search(r"(?i)(?:^|\band)\s*$", outside[: m.start()]) and m[3] == m[5] != m[1]:
            return m[1], m[2], m[4], m[6]
    return None


def has_equality(condition: str) -> bool:
    """Whether an equality of a target and a source column must hold for the whole condition."""
    flat, depth = "", 0
    for char in condition:
        depth -= char == ")"
        flat += char if depth == 0 else " "
        depth += char == "("
    side = r"(?:target|source)\.`?\w+`?"
    terms = re.split(r"(?i)\band\b", flat)
    found = [re.fullmatch(rf"\s*({side})\s*={{1,2}}\s*({side})\s*", t) for t in terms]
    crossing = any(m and m[1].split(".")[0] != m[2].split(".")[0] for m in found)
    return crossing and not re.search(r"(?i)\bor\b", flat)


def _check_columns(target: DataFrame, source: DataFrame) -> None:
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"target has no column {unknown}")


# -- slowly changing history ---------------------------------------------------------------------


def scd2_start(source: DataFrame, as_of=None) -> DataFrame:
    """First load: every row is a current version."""
    return source.withColumns(
        {
            VALID_FROM: instant(as_of),
            VALID_TO: F.lit(None).cast("timestamp"),
            IS_CURRENT: F.lit(True),
        }
    )


def scd2_apply(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    as_of=None,
    action_column: str | None = None,
) -> DataFrame:
    """History after one load: changed current rows are closed at ``as_of`` and get a successor,
    unseen keys start a history, unchanged rows and closed versions stay.

    Change detection is null-safe. Closed versions pass through without a shuffle; only the
    current slice is joined. Two source rows for one key raise an error.
    """
    label = [] if action_column is None else [action_column]
    if target is None:
        return scd2_start(source, as_of).select("*", *[F.lit("inserted").alias(a) for a in label])

    now = instant(as_of)
    columns = target.columns
    values = [c for c in source.columns if c not in keys]
    current = target.where(F.col(IS_CURRENT))
    closed_before = target.where(~F.coalesce(F.col(IS_CURRENT), F.lit(False)))
    folded = _counted(source, keys)

    joined = current.join(folded, _same_key(keys), "left").where(_single_match("history load"))
    differs = F.col(_N).isNotNull() & any_of(
        ~ref(c).eqNullSafe(F.col(_ROW).getField(c)) for c in values if c in columns
    )

    def version(action: str, **overrides: Column) -> Column:
        fields = [overrides.get(c, ref(c)).cast(target.schema[c].dataType).alias(c) for c in columns]
        return F.struct(*fields, *[F.lit(action).alias(a) for a in label])

    def from_source(c: str) -> Column:
        if c == VALID_FROM:
            return now
        if c == IS_CURRENT:
            return F.lit(True)
        return F.col(_ROW).getField(c) if c in source.columns else F.lit(None)

    successor = version("inserted", **{c: from_source(c) for c in columns})
    closed = version("closed", **{VALID_TO: now, IS_CURRENT: F.lit(False)})
    versions = F.when(differs, F.array(closed, successor)).otherwise(F.array(version("kept")))
    carried = joined.select(F.inline(versions))

    fresh = folded.join(_known(current, source, keys), [f"{_KEY}{i}" for i in range(len(keys))], "left_anti")
    fresh = fresh.where(_single_match("history load")).select(F.inline(F.array(successor)))
    keyless = source.where(~_complete(keys)).select(F.struct(*refs(source.columns)).alias(_ROW))
    keyless = keyless.select(F.inline(F.array(successor)))
    history = closed_before.select(*refs(columns), *[F.lit("kept").alias(a) for a in label])
    return history.unionByName(carried).unionByName(fresh).unionByName(keyless)


def scd2_as_of(history: DataFrame, at) -> DataFrame:
    """The versions valid at an instant: start inclusive, end exclusive."""
    t = instant(at)
    ended = F.coalesce(F.col(VALID_TO) <= t, F.lit(False))
    return history.where((F.col(VALID_FROM) <= t) & ~ended)


def scd2_current(history: DataFrame) -> DataFrame:
    return history.where(F.col(IS_CURRENT))
