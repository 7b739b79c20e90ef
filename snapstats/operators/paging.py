"""Sorted pages, near the top or deep inside a large table."""

from __future__ import annotations

import functools
import operator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstats.operators.shape import fresh_name, quoted

DIRECT_ROWS = 100_000
MERGED_ROWS = 5_000_000
QUANTILES = 1_000
SKETCH_ACCURACY = 10_000
SAMPLE = 400
MAX_PASSES = 40

#: Types that a quantile sketch takes, and those whose values pass through the driver unchanged.
_SKETCHED = (T.IntegralType, T.DateType, T.TimestampType, T.DoubleType, T.FloatType)
_PLAIN = (T.IntegralType, T.DoubleType, T.FloatType)
_UNORDERED = (T.MapType, T.VariantType)


class SortKey(NamedTuple):
    """Sort column; null is the lowest value (first ascending, last descending)."""

    column: Column
    ascending: bool = True

    def order(self) -> Column:
        return self.column.asc_nulls_first() if self.ascending else self.column.desc_nulls_last()

    def before(self, value: Column | None) -> Column:
        """Rows sorted before ``value`` (None stands for null)."""
        c = self.column
        if value is None:
            return F.lit(False) if self.ascending else c.isNotNull()
        if self.ascending:
            return c.isNull() | (c < value)
        return F.coalesce(c > value, F.lit(False))

    def same(self, value: Column | None) -> Column:
        return self.column.isNull() if value is None else self.column == value

    def after(self, value: Column | None) -> Column:
        c = self.column
        if value is None:
            return c.isNotNull() if self.ascending else F.lit(False)
        return c > value if self.ascending else (c < value) | c.isNull()


class Span(NamedTuple):
    """A value of the sort column, with the numbers of rows before it and up to it."""

    value: Column | None
    before: int
    through: int


def resolve_field(frame: DataFrame, name: str) -> Column | None:
    """A column by name or dotted path, or None when there is no such field or it cannot be sorted."""
    if name in frame.columns:
        path: tuple[str, ...] = (name,)
    else:
        path = tuple(name.split("."))
    dtype: T.DataType = frame.schema
    for step in path:
        if not isinstance(dtype, T.StructType) or step not in dtype.names:
            return None
        dtype = dtype[step].dataType
    return None if _holds_map(dtype) else quoted(*path)


def with_positions(table: DataFrame) -> tuple[DataFrame, str, str]:
    """Rows of a Parquet table with their file and place in it, and the names of these two columns."""
    file, row = fresh_name("_file", table), fresh_name("_row", table)
    return table.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)), file, row


def fetch_page(placed: DataFrame, file: str, row: str, keys: list[SortKey], offset: int, count: int, direct: int) -> DataFrame:
    """`page_rows` of a table with positions, reading whole rows only where the page is.

    The sort reads the sort columns alone; then the rows, at most one page, are fetched by their positions
    from just the files that hold them.
    """
    tasks = placed.rdd.getNumPartitions()  # of a plain scan: known without a job
    page = page_rows(placed, keys, offset, count, direct, tasks)
    ranged = bool(keys) and isinstance(placed.select(keys[0].column).schema[0].dataType, _PLAIN)
    found = page.select(file, row, (keys[0].column if ranged else F.lit(None)).alias("v")).collect()
    if not found:
        return placed.limit(0)
    spots: dict[str, list[int]] = {}
    for spot in found:
        spots.setdefault(spot[0], []).append(spot[1])
    here = [(F.col(file) == path) & F.col(row).isin(rows) for path, rows in spots.items()]
    held = placed.where(F.col(file).isin(list(spots)) & functools.reduce(operator.or_, here))
    if ranged and all(spot[2] is not None and spot[2] == spot[2] for spot in found):
        # says nothing new of the rows, but lets Parquet pass over row groups without such values
        held = held.where(keys[0].column.between(min(spot[2] for spot in found), max(spot[2] for spot in found)))
    # the limit drops nothing: it makes this a top-k, which needs no range partitioning of so few rows
    return sort_rows(held, keys).limit(count)


def row_hash(frame: DataFrame) -> Column:
    """A number that orders rows the same way on every run."""
    parts = [F.to_json(F.struct(quoted(f.name))) if _holds_map(f.dataType) else quoted(f.name) for f in frame.schema]
    return F.xxhash64(*parts)


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype)
    return isinstance(dtype, _UNORDERED)


def sort_rows(frame: DataFrame, keys: list[SortKey]) -> DataFrame:
    return frame.orderBy(*[k.order() for k in keys]) if keys else frame


def page_rows(
    frame: DataFrame, keys: list[SortKey], offset: int, count: int, direct: int = DIRECT_ROWS, tasks: int = 1
) -> DataFrame:
    """Rows ``offset`` to ``offset + count`` of the sorted frame.

    Near the top of a moderate table this is one top-k plan.  A top-k keeps ``offset + count`` rows in each
    of its ``tasks`` and merges them all in one, so a page beyond ``direct`` rows, or a table of very many
    tasks, is first narrowed: counting rows between a few values of the sort column tells between which of
    them the page lies, and only that range is sorted.  The values come from a quantile sketch around the page, so
    that one pass for the sketch and one that counts leave a few thousandths of the rows.  A pass reads one column
    and returns a few numbers.  When one value holds many rows, the next sort column narrows within it.

    A large page (more rows than ``direct`` and than the sketch has steps) never passes through one task: the rows between
    two counted values that both lie in it are taken whole, by their values, and only its two ends are narrowed.
    """
    if not keys or (_fits(offset, count, direct, tasks) and not _large(count, direct)):
        return sort_rows(frame, keys).offset(offset).limit(count)
    if _large(count, direct):
        return sort_rows(_narrow(frame, keys, 0, offset, count, direct, tasks), keys)
    return _narrow(frame, keys, 0, offset, count, direct, tasks)


def _large(count: int, direct: int) -> bool:
    return count > max(direct, QUANTILES)


def _fits(offset: int, count: int, direct: int, tasks: int, rows: int | None = None) -> bool:
    """Whether a top-k is light: few rows kept per task, and few merged (no more than there are)."""
    merged = tasks * (offset + count)
    return offset <= direct and (merged if rows is None else min(merged, rows)) <= MERGED_ROWS


def _narrow(
    frame: DataFrame, keys: list[SortKey], at: int, offset: int, count: int, direct: int, tasks: int, rows: int | None = None
) -> DataFrame:
    end = rows is not None  # of a large page, whose parts need no order
    if end and offset == 0 and count >= rows:
        return frame
    if at == len(keys):  # rows equal in every column: any of them will do, but as many must be passed over
        return frame.offset(offset).limit(count)
    key = keys[at]
    for seed in range(MAX_PASSES):
        if _large(count, direct):
            if offset == 0 and rows is not None and count >= rows:
                return frame
        elif _fits(offset, count, direct, tasks, rows) or (end and rows <= DIRECT_ROWS):
            break
        rows, spans = _count_spans(frame, key, _split_values(frame, key, seed, offset, count, rows))
        count = min(count, rows - offset)
        if count <= 0:
            return frame.limit(0)
        if _large(count, direct) and any(_meets(span, offset, count) for span in spans):
            return _whole_between(frame, keys, at, spans, rows, offset, count, direct, tasks)
        reached = [span for span in spans if span.before <= offset]
        beyond = [span for span in spans if span.before >= offset + count]
        if beyond:
            frame, rows = frame.where(key.before(beyond[0].value)), beyond[0].before
        if reached:
            low = reached[-1]
            if low.through <= offset:
                frame, skipped = frame.where(key.after(low.value)), low.through
            elif not _fits(offset - low.before, count, direct, tasks, low.through - low.before):
                return _inside_run(frame, keys, at, low, offset - low.before, count, direct, tasks)
            else:
                frame, skipped = frame.where(key.same(low.value) | key.after(low.value)), low.before
            offset, rows = offset - skipped, rows - skipped
    return sort_rows(frame, keys[at:]).offset(offset).limit(count)


def _meets(span: Span, offset: int, count: int) -> bool:
    return span.before < offset + count and span.through > offset


def _whole_between(
    frame: DataFrame, keys: list[SortKey], at: int, spans: list[Span], rows: int, offset: int, count: int, direct: int, tasks: int
) -> DataFrame:
    """A large page in no order: all rows from its first to its last counted value, and its rows around them.

    Where the page starts or ends among the rows of one value, the next sort column narrows within that value.
    """
    key, stop, met = keys[at], offset + count, [span for span in spans if _meets(span, offset, count)]
    first, last, parts = met[0], met[-1], []
    after, begin = key.same(first.value) | key.after(first.value), first.before
    if first.before < offset:
        inside = frame.where(key.same(first.value))
        size = min(first.through, stop) - offset
        parts.append(_narrow(inside, keys, at + 1, offset - first.before, size, direct, tasks, first.through - first.before))
        after, begin = key.after(first.value), first.through
    elif first.before > offset:
        head, skipped = frame.where(key.before(first.value)), 0
        for low in [span for span in spans if span.through <= offset][-1:]:
            head, skipped = head.where(key.after(low.value)), low.through
        parts.append(_narrow(head, keys, at, offset - skipped, first.before - offset, direct, tasks, first.before - skipped))
    before, finish = key.before(last.value) | key.same(last.value), last.through
    if last.through > stop:
        before, finish = key.before(last.value), last.before
        if last is not first or first.before >= offset:  # else the page is inside one value
            inside = frame.where(key.same(last.value))
            parts.append(_narrow(inside, keys, at + 1, 0, stop - last.before, direct, tasks, last.through - last.before))
    elif last.through < stop:
        tail, size = frame.where(key.after(last.value)), rows
        for high in [span for span in spans if span.before >= stop][:1]:
            tail, size = tail.where(key.before(high.value)), high.before
        parts.append(_narrow(tail, keys, at, 0, stop - last.through, direct, tasks, size - last.through))
    if begin < finish:
        parts.append(frame.where(after & before))
    return functools.reduce(DataFrame.unionByName, parts)


def _inside_run(
    frame: DataFrame, keys: list[SortKey], at: int, run: Span, offset: int, count: int, direct: int, tasks: int
) -> DataFrame:
    """A page that starts among the rows of one hot value and may end after them."""
    key = keys[at]
    inside = min(count, run.through - run.before - offset)
    first = _narrow(frame.where(key.same(run.value)), keys, at + 1, offset, inside, direct, tasks)
    if inside == count:
        return first
    following = _narrow(frame.where(key.after(run.value)), keys, at, 0, count - inside, direct, tasks)
    return sort_rows(first.unionByName(following), keys[at:]).limit(count)


def _split_values(
    frame: DataFrame, key: SortKey, seed: int, offset: int, count: int, rows: int | None
) -> list[Column | None]:
    """A few values of the sort column around the page, in sort order, as literals of its exact type.

    Numbers, dates and times come from a sketch of all rows, filled in one pass, whose quantiles are off by a
    tenth of their distance; other types from a sample of some ``SAMPLE`` rows, taken four deviations around the page.
    Which values they are only decides how much one count narrows.
    """
    dtype = frame.select(key.column.alias("v")).schema["v"].dataType
    near = _sketched(frame, key, offset, count) if isinstance(dtype, _SKETCHED) else _sampled(frame, key, seed, offset, count, rows)
    shown, null = near.select(F.transform("near", lambda v: _as_text(v, dtype)), "null").first()
    splits = [_from_text(s, dtype) for s in shown]
    if null:
        splits.insert(0 if key.ascending else len(splits), None)
    return splits


def _sketched(frame: DataFrame, key: SortKey, offset: int, count: int) -> DataFrame:
    """One row: the quantiles ``near`` the page, distinct and in sort order, and whether there is a ``null``."""
    values = frame.select(key.column.alias("v"))
    floating = isinstance(values.schema["v"].dataType, (T.DoubleType, T.FloatType))
    ranked = values.withColumn("r", F.when(~F.isnan("v"), F.col("v")) if floating else F.col("v"))
    steps = f"array({', '.join(f'{n / QUANTILES}D' for n in range(QUANTILES + 1))})"
    found = ranked.agg(
        F.coalesce(F.expr(f"percentile_approx(r, {steps}, {SKETCH_ACCURACY})"), F.array().cast(T.ArrayType(ranked.schema["r"].dataType))).alias("q"),
        F.count("r").alias("n"), F.count_if(F.col("v").isNull()).alias("nulls"), F.count_if(F.col("v").isNotNull()).alias("known"),
    )
    # ranks of the page among the sketched rows; NaN is the highest value of all
    skipped = F.col("nulls") if key.ascending else F.col("known") - F.col("n")

    def step(place: int) -> Column:
        share = (F.lit(place) - skipped) / F.greatest("n", F.lit(1)) * QUANTILES
        return share if key.ascending else QUANTILES - share

    at = [F.floor(step(place)) + move for place in (offset, offset + count) for move in (-2, -1, 0, 1, 2, 3)]
    near = _near(F.col("q"), at, key)
    if floating:  # NaN may be a hot value, too
        nan = F.array(F.lit(float("nan")).cast(values.schema["v"].dataType))
        near = F.when(F.col("known") == F.col("n"), near).otherwise(F.concat(near, nan) if key.ascending else F.concat(nan, near))
    return found.select(near.alias("near"), (F.col("nulls") > 0).alias("null"))


def _sampled(frame: DataFrame, key: SortKey, seed: int, offset: int, count: int, rows: int | None) -> DataFrame:
    """What `_sketched` gives, by a random sample."""
    rows = max(frame.count() if rows is None else rows, 1)
    some = frame.select(key.column.alias("v"), F.rand(seed).alias("r")).where(F.col("r") < 4 * SAMPLE / rows).orderBy("r").limit(SAMPLE)
    found = some.agg(F.collect_list("v").alias("q"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("v").isNull()).alias("nulls"))
    deviation = SAMPLE**0.5 / 2
    at = []
    for place in (offset, offset + count):
        rank = F.lit(place / rows) * F.col("n") - (F.col("nulls") if key.ascending else F.lit(0))
        ascending = rank if key.ascending else F.size("q") - rank
        at += [F.floor(ascending + move * deviation) for move in (-4, -2.5, -1.5, -0.5, 0.5, 1.5, 2.5, 4)]
    return found.select(_near(F.array_sort("q"), at, key).alias("near"), (F.col("nulls") > 0).alias("null"))


def _near(values: Column, at: list[Column], key: SortKey) -> Column:
    """The values of a sorted array at some places, distinct and in sort order; places outside mean its ends."""
    ends = [F.greatest(F.least(place, F.size(values) - 1), F.lit(0)).cast("int") for place in at]
    picked = F.transform(F.array_distinct(F.array(*ends)), lambda n: F.get(values, n))
    return F.sort_array(F.array_distinct(F.filter(picked, lambda v: v.isNotNull())), key.ascending)


def _as_text(value: Column, dtype: T.DataType) -> Column:
    """A value with each of its leaves as exact text; arrays and structs keep their form."""
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda e: _as_text(e, dtype.elementType))
    if isinstance(dtype, T.StructType):
        leaves = [_as_text(value.getField(f.name), f.dataType).alias(f"f{n}") for n, f in enumerate(dtype)]
        return F.when(value.isNotNull(), F.struct(*leaves))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value).cast("string")
    return F.hex(value) if isinstance(dtype, T.BinaryType) else value.cast("string")


def _from_text(shown, dtype: T.DataType) -> Column:
    """The literal of what `_as_text` showed."""
    if shown is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.ArrayType):
        return F.array(*[_from_text(e, dtype.elementType) for e in shown]).cast(dtype)
    if isinstance(dtype, T.StructType):
        return F.struct(*[_from_text(e, f.dataType).alias(f.name) for e, f in zip(shown, dtype, strict=True)]).cast(dtype)
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(int(shown)))
    return F.unhex(F.lit(shown)) if isinstance(dtype, T.BinaryType) else F.lit(shown).cast(dtype)


def _count_spans(frame: DataFrame, key: SortKey, splits: list[Column | None]) -> tuple[int, list[Span]]:
    """Row total, and how many rows lie before and up to each split value."""
    def place(low: int, high: int) -> Column:
        """Even numbers are the gaps around the split values, odd numbers the values; found by bisection."""
        if low == high:
            return F.lit(2 * low)
        middle = (low + high) // 2
        value = splits[middle]
        return (
            F.when(key.before(value), place(low, middle))
            .when(key.same(value), 2 * middle + 1)
            .otherwise(place(middle + 1, high))
        )

    placed = frame.groupBy(place(0, len(splits)).alias("place")).count()
    sizes = {row["place"]: row["count"] for row in placed.collect()}
    spans, seen = [], 0
    for n, value in enumerate(splits):
        before = seen + sizes.get(2 * n, 0)
        seen = before + sizes.get(2 * n + 1, 0)
        spans.append(Span(value, before, seen))
    return seen + sizes.get(2 * len(splits), 0), spans
