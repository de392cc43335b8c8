"""Joins of two or more frames.

Broadcasts are only asked for after a size check. Everything else shuffles on
the join keys, where adaptive execution splits hot keys of the side that the
join type lets it split. ``hot_keys=True`` on :func:`join_using` covers the
outer joins it cannot split.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted spellings of each join type.
JOIN_TYPES = {
    "inner": "inner",
    "cross": "cross",
    "left": "left",
    "leftouter": "left",
    "right": "right",
    "rightouter": "right",
    "outer": "full",
    "full": "full",
    "fullouter": "full",
    "semi": "left_semi",
    "leftsemi": "left_semi",
    "anti": "left_anti",
    "leftanti": "left_anti",
}

BROADCAST_LIMIT = 16 * 1024 * 1024

Frames = Mapping[str, DataFrame] | Sequence[tuple[str, DataFrame]]


def join_type(how: str) -> str:
    spelled = how.lower().replace("_", "").replace(" ", "")
    if spelled not in JOIN_TYPES:
        raise ValueError(f"unknown join type {how!r}; use one of {sorted(JOIN_TYPES)}")
    return JOIN_TYPES[spelled]


def planned_bytes(df: DataFrame) -> int:
    """Upper estimate of the frame's size, as the optimizer sees it.

    The optimizer does not see how many rows an ``explode`` adds, so such a
    frame counts as too large, as does one of a session without statistics.
    """
    frame = getattr(df, "_jdf", None)
    if frame is None:
        return sys.maxsize
    plan = frame.queryExecution().optimizedPlan()
    if "Generate " in plan.toString():
        return sys.maxsize
    return int(str(plan.stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only while the planned size stays under ``limit``.

    A frame that has grown past it is joined by shuffling instead.
    """
    return F.broadcast(df) if planned_bytes(df) <= limit else df


def join_frames(
    frames: Frames,
    conditions: Sequence[str],
    how: str = "inner",
    *,
    key_policy: str = "coalesce",
    hot_keys: bool = False,
    broadcast: Iterable[str] = (),
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Join N frames left to right with N-1 SQL conditions over their names.

    When a whole condition is ``a.k = b.k`` the result keeps one ``k``. For
    right and full joins it holds whichever side is not NULL; with
    ``key_policy="left"`` it stays the left value, NULL for right-only rows.
    A later condition may still name a key that the result keeps only once.
    Conditions may be any predicate, but one without an equality pairs every
    row with every row, so give one wherever the data is large. ``hot_keys``
    gives the same rows; it needs conditions of the form ``a.k = b.k`` and
    reads each input up to three times. See :func:`join_using`.
    """
    if key_policy not in ("coalesce", "left"):
        raise ValueError("key_policy is 'coalesce' or 'left'")
    named = list(frames.items()) if isinstance(frames, Mapping) else list(frames)
    if len(named) < 2:
        raise ValueError("a join needs at least two frames")
    if len(conditions) != len(named) - 1:
        raise ValueError(f"{len(named)} frames need {len(named) - 1} join conditions")
    names = [name for name, _ in named]
    if len(set(names)) != len(names):
        raise ValueError("give each frame its own name; a self join uses two names")
    kind = join_type(how)
    step_kind = "inner" if kind == "cross" else kind  # a cross join filtered by its condition
    filtering = kind in ("left_semi", "left_anti")
    small = set(broadcast)

    def flat(name: str, frame: DataFrame) -> DataFrame:
        """The frame under names that no other frame has."""
        return frame.select(*[F.col(f"`{c}`").alias(_flat(name, c)) for c in frame.columns])

    result = flat(*named[0]) if hot_keys else named[0][1].alias(names[0])
    merged: dict[tuple[str, str], tuple[str, str]] = {}
    for (name, frame), condition in zip(named[1:], conditions):
        shared = _shared_key(condition, name)
        if shared and filtering and shared in merged:  # that frame is gone; its key is the kept one
            shared = merged[shared]
            condition = f"`{shared[0]}`.`{shared[1]}` = `{name}`.`{shared[1]}`"
        if hot_keys:
            if shared is None:
                raise ValueError(f"hot_keys needs conditions like a.k = b.k, not {condition!r}")
            keys = _flat(*shared), _flat(name, shared[1])
            result = _join_in_parts(result, flat(name, frame), *([key] for key in keys), step_kind)
        else:
            right = broadcast_if_small(frame, broadcast_limit) if name in small else frame
            if shared:  # so that the bare key still means the first one
                right = right.withColumnRenamed(shared[1], _flat(name, shared[1]))
            for own in [*merged, *([(name, shared[1])] if shared else [])]:
                spelled = rf"(?<![\w`.])`?{own[0]}`?\.`?{own[1]}(?:`|(?!\w))"
                condition = _replaced(condition, spelled, f"`{own[0]}`.`{_flat(*own)}`")
            result = result.join(right.alias(name), F.expr(condition), step_kind)
        if shared:
            merged[(name, shared[1])] = merged.get(shared, shared)
    late = kind in ("right", "full") and key_policy == "coalesce"
    kept = named[:1] if filtering else named


    def column(name: str, c: str) -> Column:
        if hot_keys:
            return F.col(f"`{_flat(name, c)}`").alias(c)
        return _qualified(name, _flat(name, c) if (name, c) in merged else c)

    return result.select(*_with_merged_keys(kept, merged, late, column))


_LITERAL = re.compile(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")""", re.DOTALL)


def _replaced(condition: str, pattern: str, by: str) -> str:
    """The condition with every match replaced outside its string literals."""
    parts = _LITERAL.split(condition)
    parts[::2] = [re.sub(pattern, lambda _: by, part) for part in parts[::2]]
    return "".join(parts)


def _flat(frame: str, column: str) -> str:
    return f"{frame}:{column}"


def join_using(
    frames: Sequence[DataFrame],
    on: str | Sequence[str],
    how: str = "inner",
    *,
    hot_keys: bool = False,
    broadcast: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Join frames on equally named key columns, keeping one copy of each key.

    ``hot_keys=True`` builds an outer join from an inner join, which adaptive
    execution can split on both sides, and the rows without a partner. Those
    come from an anti join against the other side's distinct keys, so no task
    ever has to buffer all rows of one key.
    """
    if len(frames) < 2:
        raise ValueError("a join needs at least two frames")
    keys = [on] if isinstance(on, str) else list(on)
    kind = join_type(how)

    def step(left: DataFrame, right: DataFrame) -> DataFrame:
        step_kind = "inner" if kind == "cross" else kind
        if hot_keys:
            return _join_using_in_parts(left, right, keys, step_kind)
        if broadcast:
            right = broadcast_if_small(right, broadcast_limit)
        return left.join(right, keys, step_kind)

    return reduce(step, frames)


def _join_using_in_parts(left: DataFrame, right: DataFrame, keys: list[str], kind: str) -> DataFrame:
    if kind in ("left_semi", "left_anti"):
        return left.join(right.select(*keys).distinct(), keys, kind)
    # by position, as a plain join does, so that both sides may have a column of the same name
    ours, theirs = ([f"{side}{i}" for i in range(len(df.columns))] for side, df in (("l", left), ("r", right)))
    on = [[names[df.columns.index(key)] for key in keys] for names, df in ((ours, left), (theirs, right))]
    joined = _join_in_parts(left.toDF(*ours), right.toDF(*theirs), *on, kind)
    columns = [F.coalesce(a, b).alias(key) for key, a, b in zip(keys, *on)]
    for names, df in ((ours, left), (theirs, right)):
        columns += [F.col(name).alias(c) for name, c in zip(names, df.columns) if c not in keys]
    return joined.select(*columns)


def _join_in_parts(
    left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], kind: str
) -> DataFrame:
    """Join frames without a common column name: an inner join, and the rows without a partner."""

    def matched(a: DataFrame, b: DataFrame, a_keys: list[str], b_keys: list[str], how: str) -> DataFrame:
        return a.join(b, [F.col(f"`{x}`") == F.col(f"`{y}`") for x, y in zip(a_keys, b_keys)], how)

    def distinct(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.select(*[F.col(f"`{key}`") for key in keys]).distinct()

    if kind in ("left_semi", "left_anti"):
        return matched(left, distinct(right, right_keys), left_keys, right_keys, kind)
    parts = [matched(left, right, left_keys, right_keys, "inner")]
    if kind in ("left", "full"):
        parts.append(matched(left, distinct(right, right_keys), left_keys, right_keys, "left_anti"))
    if kind in ("right", "full"):
        parts.append(matched(right, distinct(left, left_keys), right_keys, left_keys, "left_anti"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _qualified(frame: str, column: str) -> Column:
    return F.col(f"`{frame}`.`{column}`")


def _shared_key(condition: str, right: str) -> tuple[str, str] | None:
    """(left frame, key) when the condition only equates one shared key name."""
    sides = [side.strip().split(".") for side in condition.split("=")]
    if len(sides) != 2 or any(len(side) != 2 for side in sides):
        return None
    if not all(re.fullmatch(r"\w+", word) for side in sides for word in side):
        return None
    (frame_a, key_a), (frame_b, key_b) = sides
    if key_a != key_b or right not in (frame_a, frame_b) or frame_a == frame_b:
        return None
    return (frame_a if frame_b == right else frame_b), key_a


def _with_merged_keys(
    named: list[tuple[str, DataFrame]],
    merged: dict[tuple[str, str], tuple[str, str]],
    coalesce: bool,
    value_of: Callable[[str, str], Column],
) -> list[Column]:
    """All columns of the frames in order, each merged key once."""
    columns = []
    for name, frame in named:
        for column in frame.columns:
            if (name, column) in merged:
                continue
            copies = [own for own, kept in merged.items() if kept == (name, column)]
            value = value_of(name, column)
            if copies and coalesce:
                value = F.coalesce(value, *[value_of(*copy) for copy in copies]).alias(column)
            columns.append(value)
    return columns
