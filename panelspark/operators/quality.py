"""Data-quality checks. Each returns the violating rows; none means the check passes.

Checks on order (ranges, sequences) and on duplicates return equal violations once, with
their number of rows in ``n_rows``, so a value repeated without end stays one row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V
from .joins import join_same
from .ranking import value_neighbours


def _violates(condition: Column) -> Column:
    """NOT condition, where an unknown condition passes."""
    return ~F.coalesce(condition, F.lit(True))


def _out_of_range(column: str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    c, conditions = F.col(column), []
    if min_value is not None:
        conditions.append(c >= min_value if inclusive else c > min_value)
    if max_value is not None:
        conditions.append(c <= max_value if inclusive else c < max_value)
    return _violates(reduce(lambda a, b: a & b, conditions, F.lit(True)))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    return df.where(_out_of_range(column, min_value, max_value, inclusive))


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the whole table) without any known value."""
    return df.groupBy(*group_by).agg(F.count(column).alias("n_known")).where("n_known = 0")


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field_name: str) -> DataFrame:
    """Values whose row count differs between two columns, with the count on the side that has it."""
    def counts(frame, c, side):
        return frame.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("num_rows")).withColumn("__side", F.lit(side))
    both = counts(df, column, 1).unionByName(counts(to, field_name, 2))
    return (both.groupBy("value", "num_rows").agg(F.count(F.lit(1)).alias("__sides")).where("__sides = 1")
            .select("value", "num_rows"))


def _group_counts(df: DataFrame, compare: DataFrame, group_by: Sequence[str], strict: bool) -> DataFrame:
    def side(frame, a, b):
        return frame.groupBy(*group_by).agg(F.count(F.lit(1)).alias("__n")).select(
            *group_by, (F.col("__n") if a else F.lit(None).cast("bigint")).alias("count_a"),
            (F.col("__n") if b else F.lit(None).cast("bigint")).alias("count_b"))
    both = side(df, True, False).unionByName(side(compare, False, True))
    counts = both.groupBy(*group_by).agg(F.sum("count_a").alias("count_a"), F.sum("count_b").alias("count_b"))
    return counts.na.fill(0, ["count_a", "count_b"]) if strict else counts


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Groups whose row counts differ; a group missing on one side only counts when ``strict``."""
    counts = _group_counts(df, compare, group_by, strict)
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b"))).where("diff_count > 0")


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups that do not have fewer rows than ``compare``: the surplus when there are more, 1 when equal."""
    a, b = F.col("count_a"), F.col("count_b")
    delta = F.when(a > b, a - b).when(a == b, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return _group_counts(df, compare, group_by, False).withColumn("row_count_delta", delta).where("row_count_delta > 0")


DIGEST_BUCKETS = 4096


def _differing_buckets(both: DataFrame, names: Sequence[str]) -> DataFrame:
    """Hash buckets whose rows on the two sides do not have the same digest.

    A digest is the row count and the sums of the halves of two 64-bit hashes, so it needs no order. Equal digests of
    different rows would take some 110 equal bits; different digests of equal sets (repeated rows) only cost a look.
    """
    hashes = [F.xxhash64(*names), F.xxhash64(F.lit(1), *names)]
    halves = [h for x in hashes for h in (x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(x, 32))]
    balance = [F.sum(F.when(F.col("__a") == 1, v).otherwise(-v)).alias(f"__d{i}")
               for i, v in enumerate([F.lit(1).cast("bigint"), *halves])]
    differs = reduce(lambda a, b: a | b, [F.col(f"__d{i}") != 0 for i in range(len(balance))])
    return both.groupBy("__bucket").agg(*balance).where(differs).select("__bucket")


def equality(df: DataFrame, compare: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows present on one side only, tagged ``a_minus_b`` or ``b_minus_a``.

    Both sides are folded to digests per hash bucket first. Rows of buckets that agree are not shuffled; those of the
    others meet in one aggregation with partial combine, no join. At most ``DIGEST_BUCKETS`` numbers are broadcast.
    """
    names = list(columns or df.columns)
    both = df.select(*names, F.lit(1).alias("__a"), F.lit(0).alias("__b")).unionByName(
        compare.select(*names, F.lit(0).alias("__a"), F.lit(1).alias("__b")))
    both = both.withColumn("__bucket", F.pmod(F.xxhash64(*names), F.lit(DIGEST_BUCKETS)))
    rows = both.join(F.broadcast(_differing_buckets(both, names)), "__bucket", "left_semi")
    seen = rows.groupBy(*names).agg(F.max("__a").alias("__a"), F.max("__b").alias("__b")).where("__a <> __b")
    return seen.select(F.when(F.col("__a") == 1, "a_minus_b").otherwise("b_minus_a").alias("which_diff"), *names)


def equality_failures() -> Column:
    """Failure count of ``equality``: differing rows plus the imbalance between the sides."""
    way = F.when(F.col("which_diff") == "a_minus_b", 1).when(F.col("which_diff") == "b_minus_a", -1)
    return F.count(F.lit(1)) + F.coalesce(F.abs(F.sum(way)), F.lit(0))


def _is_not_true(expression: str, column: str | None = None) -> Column:
    return _violates(F.expr(expression if column is None else f"`{column}` {expression}"))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    return df.where(_is_not_true(expression, column))


_GAP = {"not_allowed": lambda upper, following: upper == following,
        "allowed": lambda upper, following: upper <= following,
        "required": lambda upper, following: upper < following}


def mutually_exclusive_ranges(df: DataFrame, lower: str, upper: str, partition_by: Sequence[str] = (),
                              gaps: str = "allowed", zero_length_range_allowed: bool = False) -> DataFrame:
    """Ranges that are reversed, or that clash with the next range of their group.

    The order is (lower, upper). Only the last range of a lower bound meets the next lower bound; the
    others are followed by an equal one. So neighbours are looked up among distinct lower bounds.
    """
    if gaps not in _GAP:
        raise ValueError(f"gaps must be one of {sorted(_GAP)}, got {gaps!r}")
    keys = list(partition_by)
    rows = df.select(*keys, F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound"))
    bounds = value_neighbours(rows, keys, "lower_bound", [
        F.max("upper_bound").alias("__top"), F.sum(F.col("upper_bound").isNull().cast("int")).alias("__open"),
    ]).drop("__n", "__prev")
    distinct = rows.groupBy(*keys, "lower_bound", "upper_bound").agg(F.count(F.lit(1)).alias("__n"))
    placed = join_same(distinct, bounds, [*keys, "lower_bound"])
    closes = F.when(F.col("__open") > 0, F.col("upper_bound").isNull()).otherwise(F.col("upper_bound") == F.col("__top"))
    last = F.when(F.coalesce(closes, F.lit(False)), 1).otherwise(0)
    entries = F.explode(F.array(
        F.struct(F.col("lower_bound").alias("next_lower_bound"), (F.col("__n") - last).alias("n_rows")),
        F.struct(F.col("__next").alias("next_lower_bound"), last.cast("bigint").alias("n_rows"))))
    lo, up, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    length_ok = F.coalesce(lo <= up if zero_length_range_allowed else lo < up, F.lit(False))
    gap_ok = F.coalesce(_GAP[gaps](up, following), following.isNull())
    return (placed.select(*keys, "lower_bound", "upper_bound", entries.alias("e"))
            .select(*keys, "lower_bound", "upper_bound", "e.*")
            .where((F.col("n_rows") > 0) & ~(length_ok & gap_ok)))


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Forbidden values that occur."""
    return df.where(F.col(column).isin(list(values))).select(F.col(column).alias("value_field")).distinct()


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the whole table) with exactly one distinct known value."""
    distinct = df.groupBy(*group_by).agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    return distinct.where("__lo = __hi").select(*group_by, F.lit(1).cast("bigint").alias("n_distinct"))


def _is_empty(column: str, trim_whitespace: bool = True) -> Column:
    return (F.trim(F.col(column)) if trim_whitespace else F.col(column)) == ""


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    return df.where(_is_empty(column, trim_whitespace))


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0,
                        group_by: Sequence[str] = ()) -> DataFrame:
    """Groups whose share of known values is out of bounds."""
    share = F.avg(F.col(column).isNotNull().cast("int")).alias("not_null_proportion")
    return df.groupBy(*group_by).agg(share).where(~F.col("not_null_proportion").between(at_least, at_most))


def recency(df: DataFrame, column: str, datepart: str, interval: int, as_of: Column | None = None,
            ignore_time_component: bool = False, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups whose latest value is older than the interval; no value at all passes."""
    kind = "date" if ignore_time_component else "timestamp_ntz"
    limit = F.timestamp_add(datepart.upper(), F.lit(-interval), F.current_timestamp() if as_of is None else as_of)
    newest = df.groupBy(*group_by).agg(F.max(column).cast(kind).alias("most_recent"))
    return newest.withColumn("threshold", limit.cast(kind)).where("most_recent < threshold")


def relationships_where(df: DataFrame, column: str, to: DataFrame, field_name: str, from_condition: str = "true",
                        to_condition: str = "true") -> DataFrame:
    """Known values (with their row counts) that the other relation lacks.

    Counting the values first shrinks a hot key to one row before the join.
    """
    values = (df.where(F.expr(from_condition) & F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
              .agg(F.count(F.lit(1)).alias("n_rows")))
    known = to.where(F.expr(to_condition) & F.col(field_name).isNotNull()).select(F.col(field_name).alias("value"))
    return values.join(known, "value", "left_anti")


def sequential_values(df: DataFrame, column: str, interval: int = 1, datepart: str | None = None,
                      group_by: Sequence[str] = ()) -> DataFrame:
    """Values that do not follow their predecessor at the given interval; repeats follow themselves."""
    keys = list(group_by)
    values = value_neighbours(df.select(*keys, column), keys, column)
    pairs = F.explode(F.array(
        F.struct(F.col("__prev").alias("previous_value"), F.lit(1).cast("bigint").alias("n_rows")),
        F.struct(F.col(column).alias("previous_value"), (F.col("__n") - 1).alias("n_rows"))))
    previous = F.col("previous_value")
    expected = (F.timestamp_add(datepart.upper(), F.lit(interval), previous) if datepart else previous + interval)
    return (values.select(*keys, column, pairs.alias("p")).select(*keys, column, "p.*")
            .where((F.col("n_rows") > 0) & _violates(F.col(column) == expected)))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Known values outside the list, with their row counts."""
    other = df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return other.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_rows"))


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    return df.where(_violates(F.col(actual) == F.col(expected)))


def columns_match_set(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """(column_name, problem, n_filled): columns missing from or unexpected in the table, any letter case."""
    own = {c.lower(): c for c in df.columns}
    wanted = {c.lower() for c in expected}
    extra = [c for low, c in own.items() if low not in wanted]
    missing = sorted(wanted - set(own))
    entries = [F.struct(F.lit(c.lower()).alias("column_name"), F.lit("unexpected").alias("problem"),
                        F.col(f"`{c}`").alias("n_filled")) for c in extra]
    entries += [F.struct(F.lit(c).alias("column_name"), F.lit("missing").alias("problem"),
                         F.lit(None).cast("bigint").alias("n_filled")) for c in missing]
    counts = df.agg(F.count(F.lit(1)).alias("__all"), *[F.count(f"`{c}`").alias(c) for c in extra])
    if not entries:
        return counts.where(F.lit(False)).selectExpr("'' AS column_name", "'' AS problem", "__all AS n_filled")
    return counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def freshness(df: DataFrame, stamp: str, as_of: Column | None = None, warn_hours: int = V.FRESH_WARN_HOURS,
              error_hours: int = V.FRESH_ERROR_HOURS, group_by: Sequence[str] = ()) -> DataFrame:
    """Latest load time, row count and pass / warn / error by age."""
    now = F.current_timestamp().cast("timestamp_ntz") if as_of is None else as_of
    latest = df.groupBy(*group_by).agg(F.max(stamp).alias("last_load"), F.count(F.lit(1)).alias("n_rows"))

    def older_than(hours):
        return F.col("last_load") < F.timestamp_add("HOUR", F.lit(-hours), now)
    status = F.when(older_than(error_hours), "error").when(older_than(warn_hours), "warn").otherwise("pass")
    return latest.withColumn("status", status)


@dataclass(frozen=True)
class Rule:
    """A check that needs nothing but sums over its table or over groups of it, so that many can share one scan.

    ``rows`` gives the violating rows, as the function of the same name does. ``sums`` gives named aggregates over the
    rows for which its argument holds, and ``failures`` counts the failures of a group from them. ``fails`` is the
    condition of rules on single rows. A table without groups has one group; ``empty`` is its count without rows.
    """

    rows: Callable[[DataFrame], DataFrame]
    sums: Callable[[Column], dict[str, Column]]
    failures: Callable[[dict[str, Column]], Column]
    group_by: tuple[str, ...] = ()
    fails: Column | None = None
    empty: int = 0


def _row_rule(rows: Callable[[DataFrame], DataFrame], fails: Column) -> Rule:
    return Rule(rows, lambda keep: {"n": F.count_if(keep & fails)}, lambda found: found["n"], fails=fails)


def _when(found: Column) -> Column:
    return F.when(found, 1).otherwise(0)


class rules:
    """Rules by the names and arguments of the checks they stand for, without the table."""

    @staticmethod
    def accepted_range(column: str, min_value=None, max_value=None, inclusive: bool = True) -> Rule:
        return _row_rule(lambda t: accepted_range(t, column, min_value, max_value, inclusive),
                         _out_of_range(column, min_value, max_value, inclusive))

    @staticmethod
    def expression_is_true(expression: str, column: str | None = None) -> Rule:
        return _row_rule(lambda t: expression_is_true(t, expression, column), _is_not_true(expression, column))

    @staticmethod
    def not_empty_string(column: str, trim_whitespace: bool = True) -> Rule:
        return _row_rule(lambda t: not_empty_string(t, column, trim_whitespace), _is_empty(column, trim_whitespace))

    @staticmethod
    def not_null(column: str) -> Rule:
        return _row_rule(lambda t: not_null(t, column), F.col(column).isNull())

    @staticmethod
    def assert_equal(actual: str, expected: str) -> Rule:
        return _row_rule(lambda t: assert_equal(t, actual, expected), _violates(F.col(actual) == F.col(expected)))

    @staticmethod
    def accepted_values(column: str, values: Sequence) -> Rule:
        return _row_rule(lambda t: accepted_values(t, column, values),
                         F.col(column).isNotNull() & ~F.col(column).isin(list(values)))

    @staticmethod
    def not_accepted_values(column: str, values: Sequence) -> Rule:
        """Counts the forbidden values that occur, not their rows."""
        listed = list(dict.fromkeys(values))
        return Rule(lambda t: not_accepted_values(t, column, listed),
                    lambda keep: {f"v{i}": F.count_if(keep & (F.col(column) == v)) for i, v in enumerate(listed)},
                    lambda found: reduce(lambda a, b: a + b, [_when(n > 0) for n in found.values()]))

    @staticmethod
    def at_least_one(column: str, group_by: Sequence[str] = ()) -> Rule:
        return Rule(lambda t: at_least_one(t, column, group_by),
                    lambda keep: {"known": F.count(F.when(keep, F.col(column)))},
                    lambda found: _when(found["known"] == 0), tuple(group_by), empty=1)

    @staticmethod
    def not_constant(column: str, group_by: Sequence[str] = ()) -> Rule:
        value = F.col(column)
        return Rule(lambda t: not_constant(t, column, group_by),
                    lambda keep: {"lo": F.min(F.when(keep, value)), "hi": F.max(F.when(keep, value))},
                    lambda found: _when(found["lo"] == found["hi"]), tuple(group_by))

    @staticmethod
    def not_null_proportion(column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()) -> Rule:
        return Rule(lambda t: not_null_proportion(t, column, at_least, at_most, group_by),
                    lambda keep: {"share": F.avg(F.when(keep, F.col(column).isNotNull().cast("int")))},
                    lambda found: _when(~found["share"].between(at_least, at_most)), tuple(group_by))

    @staticmethod
    def recency(column: str, datepart: str, interval: int, as_of: Column | None = None,
                ignore_time_component: bool = False, group_by: Sequence[str] = ()) -> Rule:
        kind = "date" if ignore_time_component else "timestamp_ntz"
        limit = F.timestamp_add(datepart.upper(), F.lit(-interval), F.current_timestamp() if as_of is None else as_of)
        return Rule(lambda t: recency(t, column, datepart, interval, as_of, ignore_time_component, group_by),
                    lambda keep: {"newest": F.max(F.when(keep, F.col(column))).cast(kind)},
                    lambda found: _when(found["newest"] < limit.cast(kind)), tuple(group_by))

    @staticmethod
    def unique_combination(columns: Sequence[str]) -> Rule:
        """Counts the rows of the repeated combinations."""
        return Rule(lambda t: unique_combination(t, columns), lambda keep: {"n": F.count_if(keep)},
                    lambda found: F.when(found["n"] > 1, found["n"]).otherwise(0), tuple(columns))

    @staticmethod
    def unique(column: str) -> Rule:
        return Rule(lambda t: unique(t, column), lambda keep: {"n": F.count_if(keep & F.col(column).isNotNull())},
                    lambda found: F.when(found["n"] > 1, found["n"]).otherwise(0), (column,))


@dataclass
class Check:
    """A named check: its violating rows, how to count failures, and when they matter.

    ``rows`` is the frame of violations, or a rule on ``table``, or a function from ``table`` to the violations; ``where``
    then restricts the table first. Rules on the same table are counted in one scan of it.
    Failures are rows of the table unless ``failures`` says otherwise: a check that returns equal violations once
    counts them by ``n_rows``, a check of row counts by the difference. ``error_if`` and ``warn_if`` compare the
    failure count, e.g. ``"> 0"`` or ``"< 1"``.
    """

    name: str
    rows: DataFrame | Rule | Callable[[DataFrame], DataFrame]
    failures: Column | None = None
    error_if: str = "> 0"
    warn_if: str = "> 0"
    table: DataFrame | None = None
    where: str | None = None

    def violations(self) -> DataFrame:
        if isinstance(self.rows, DataFrame):
            if self.where:
                raise ValueError(f"{self.name}: where needs a table and a function of it")
            return self.rows
        found = self.rows.rows if isinstance(self.rows, Rule) else self.rows
        return found(self.table.where(self.where) if self.where else self.table)

    @property
    def kept(self) -> Column:
        """Whether a row of the table is looked at."""
        return F.coalesce(F.expr(self.where), F.lit(False)) if self.where else F.lit(True)

    def status(self, failures: str) -> Column:
        return (F.when(F.expr(f"{failures} {self.error_if}"), "error")
                .when(F.expr(f"{failures} {self.warn_if}"), "warn").otherwise("pass"))

    @property
    def is_sum(self) -> bool:
        return isinstance(self.rows, Rule) and self.failures is None


def failure_count(violations: DataFrame) -> Column:
    """Rows of the checked table that the violations stand for."""
    for column in ("n_rows", "diff_count", "row_count_delta"):
        if column in violations.columns:
            return F.sum(column)
    return F.count(F.lit(1))


def _by_table(checks: Sequence[Check]) -> list[list[Check]]:
    """Checks whose tables have the same plan."""
    groups: list[list[Check]] = []
    for check in checks:
        same = next((g for g in groups if g[0].table.sameSemantics(check.table)), None)
        groups.append([check]) if same is None else same.append(check)
    return groups


def sum_failures(checks: Sequence[Check]) -> DataFrame:
    """(name, failures, status) of rules on one table, from one scan of it.

    Rules on single rows and on the whole table are plain conditional sums. With grouped rules the groupings are
    aggregated together as grouping sets, combined before the shuffle; a group without rows that a rule looks at does
    not count for it.
    """
    table = checks[0].table
    groupings = list(dict.fromkeys([(), *[c.rows.group_by for c in checks]]))
    columns = list(dict.fromkeys(k for g in groupings for k in g))
    sums, place = [], []
    for i, check in enumerate(checks):
        own = {"rows": F.count_if(check.kept)} | check.rows.sums(check.kept)
        sums += [c.alias(f"__{i}_{name}") for name, c in own.items()]
        place.append({name: F.col(f"__{i}_{name}") for name in own if name != "rows"})
    if columns:
        grouped = table.groupingSets([list(g) for g in groupings], *columns).agg(F.grouping_id().alias("__set"), *sums)
    else:
        grouped = table.agg(F.lit(0).cast("bigint").alias("__set"), *sums)
    totals = []
    for i, check in enumerate(checks):
        number = sum(1 << len(columns) - 1 - at for at, c in enumerate(columns) if c not in check.rows.group_by)
        inside = (F.col("__set") == number) & (F.col(f"__{i}_rows") > 0)
        count = F.sum(F.when(inside, check.rows.failures(place[i])))
        missing = check.rows.empty if not check.rows.group_by else 0
        totals.append(F.coalesce(count, F.lit(missing)).cast("bigint").alias(f"__total_{i}"))
    cells = [F.struct(F.lit(c.name).alias("name"), F.col(f"__total_{i}").alias("failures"),
                      c.status(f"__total_{i}").alias("status")) for i, c in enumerate(checks)]
    return grouped.agg(*totals).select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def failing_rows(checks: Sequence[Check], out: str = "failed_checks") -> DataFrame:
    """Rows of one table that break rules on single rows, with the names of those rules, from one scan."""
    if len(_by_table(checks)) > 1 or any(not isinstance(c.rows, Rule) or c.rows.fails is None for c in checks):
        raise ValueError("failing_rows takes rules on single rows of one table")
    names = F.array_compact(F.array(*[F.when(c.kept & c.rows.fails, F.lit(c.name)) for c in checks]))
    return checks[0].table.withColumn(out, names).where(F.size(out) > 0)


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """(name, failures, status) of all checks, run together.

    Rules share one scan of their table; checks on order, on two relations and on sets are one aggregation each.
    """
    def count(check: Check) -> DataFrame:
        found = check.violations()
        failures = failure_count(found) if check.failures is None else check.failures
        return found.agg(F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures")).select(
            F.lit(check.name).alias("name"), "failures", check.status("failures").alias("status"))

    shared = [sum_failures(g) for g in _by_table([c for c in checks if c.is_sum])]
    return reduce(DataFrame.unionByName, [*shared, *[count(c) for c in checks if not c.is_sum]])
