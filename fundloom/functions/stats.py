"""Statistics whose conventions differ between pandas and Spark, and exact quantiles at scale."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fundloom.functions.scalars import col
from fundloom.session import materialize

#: Values of one bracket that an aggregate may hold.
MOST_VALUES = 10_000


def correlation(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over complete pairs; null where one side is constant."""
    x, y = col(x), col(y)
    xs, ys = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_pop(xs) * F.stddev_pop(ys)
    return F.try_divide(F.covar_pop(xs, ys), spread)


def sample_skewness(c: str | Column) -> Column:
    """Bias-corrected skewness, null below three values."""
    c = col(c)
    n = F.count(c).cast("double")
    return F.when(n >= 3, F.try_divide(F.skewness(c) * F.sqrt(n * (n - 1)), n - 2))


def sample_excess_kurtosis(c: str | Column) -> Column:
    """Bias-corrected excess kurtosis, null below four values."""
    c = col(c)
    n = F.count(c).cast("double")
    factor = F.try_divide(n - 1, (n - 2) * (n - 3))
    return F.when(n >= 4, factor * ((n + 1) * F.kurtosis(c) + 6))


def unpivot_measures(df: DataFrame, measures: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Wide measures to long rows (keys, variable, value)."""
    wide = df.select(*[col(k) for k in keys], *[col(m).cast("double").alias(m) for m in measures])
    return wide.unpivot(
        [col(k) for k in keys], [col(m) for m in measures], "variable", "value"
    )


def exact_quantiles(
    df: DataFrame,
    measures: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = 10000,
    most: int = MOST_VALUES,
) -> DataFrame:
    """Linear-interpolated quantiles as rows (by, variable, prob, quantile), for groups of any size.

    The built-in `percentile` keeps every distinct value of a group in one task. Here a mergeable sketch brackets
    the wanted ranks; every pass is one aggregate over the frame for all measures and probabilities, combined
    before the shuffle. While a bracket may hold more than `most` values between its ends, a pass counts what lies
    below, on and between the ends and sketches the inside, which narrows the bracket; the last pass takes the
    values between the ends, `most` at most, and the ends' own counts. A bracket that its counts show not to hold a
    rank is moved to the side where the rank is. Brackets are one row for each group, written between the passes.
    Up to `most` x `accuracy` / 8 values there are two passes. Unknown values count for nothing; a group without
    known values has no row.
    """
    keys = [f"`{k}`" for k in by]
    wide = df.select(
        *[col(k) for k in by],
        *[F.nanvl(col(m).cast("double"), F.lit(None)).alias(f"_x{i}") for i, m in enumerate(measures)],
    )
    margin = 3.0 / accuracy
    ends = [max(p - margin, 0.0) for p in probs] + [min(p + margin, 1.0) for p in probs]
    targets = [(i, j) for i in range(len(measures)) for j in range(len(probs))]
    asked = f"array({', '.join(f'{e!r}D' for e in ends)})"
    sketched = wide.groupBy(*by).agg(
        *[F.expr(f"double(count(_x{i})) AS _n{i}") for i in range(len(measures))],
        *[F.expr(f"percentile_approx(_x{i}, {asked}, {accuracy}) AS _cuts{i}") for i in range(len(measures))],
    )
    listed = ", ".join(
        f"named_struct('i', {i}, 'p', {float(probs[j])!r}D, 'n', _n{i}, 'lo', _cuts{i}[{j}], "
        f"'hi', _cuts{i}[{len(probs) + j}], 'size', _n{i} * {8.0 / accuracy!r}D)"
        for i, j in targets
    )
    brackets = materialize(sketched.selectExpr(*keys, f"array({listed}) AS _s"))
    measured = [i for i, _ in targets]
    while True:
        largest = brackets.selectExpr("max(array_max(transform(_s, b -> b.size)))").first()[0] or 0.0
        if largest > most:
            brackets = materialize(_bracket_pass(wide, brackets, by, measured, accuracy, take=False))
            continue
        found = materialize(_bracket_pass(wide, brackets, by, measured, accuracy, take=True))
        if found.where("exists(_s, b -> b.size > 0)").isEmpty():
            break
        brackets = found
    names = ", ".join(f"'{m}'" for m in (str(m).replace("\\", "\\\\").replace("'", "\\'") for m in measures))
    rows = found.selectExpr(*keys, "inline(_s)")
    value = F.expr("v + (w - v) * (p * (n - 1) - floor(p * (n - 1)))")
    variable = F.expr(f"array({names})[i]")
    return rows.select(*[col(k) for k in by], variable.alias("variable"), F.col("p").alias("prob"), value.alias("quantile")).where(
        F.col("quantile").isNotNull()
    )


#: Steps in which the inside of a bracket is sketched to narrow it.
_STEPS = 64


def _bracket_pass(
    wide: DataFrame, brackets: DataFrame, by: Sequence[str], measured: Sequence[int], accuracy: int, take: bool
) -> DataFrame:
    """One pass over the frame: the values `v` and `w` at the ranks (`take`), or narrower brackets.

    `size` bounds the values between the new ends; with `take` it is 0 unless the bracket does not hold the ranks.
    `measured` names the measure of each bracket. Written as SQL, as there are many brackets.
    """
    joined = wide.join(brackets, list(by)) if by else wide.crossJoin(F.broadcast(brackets))  # one row
    grid = f"array({', '.join(f'{k / _STEPS!r}D' for k in range(_STEPS + 1))})"
    cells = []
    for t, i in enumerate(measured):
        x, lo, hi = f"_x{i}", f"_s[{t}].lo", f"_s[{t}].hi"
        between = f"CASE WHEN ({lo} IS NULL OR {x} > {lo}) AND ({hi} IS NULL OR {x} < {hi}) THEN {x} END"
        inner = f"sort_array(collect_list({between}))" if take else f"percentile_approx({between}, {grid}, {accuracy})"
        cells.append(
            f"named_struct('under', count_if({x} < {lo}), 'low', count_if({x} = {lo}), 'mid', count({between}), "
            f"'high', count_if({x} = {hi} AND NOT {lo} <=> {hi}), 'inner', {inner})"
        )
    found = joined.groupBy(*by).agg(F.first("_s").alias("_s"), F.expr(f"array({', '.join(cells)})").alias("_c"))
    # ranks next to the wanted place, then where they lie
    placed = """transform(arrays_zip(_s, _c), z -> named_struct('b', z._s, 'c', z._c, 'r0', floor(z._s.p * (z._s.n - 1)),
      'r1', ceil(z._s.p * (z._s.n - 1)), 'm', z._c.under + z._c.low, 'h', z._c.under + z._c.low + z._c.mid))"""
    early, late = "r.r0 < r.c.under", "r.r1 >= r.h + r.c.high"
    if take:
        def at(rank: str) -> str:
            return f"CASE WHEN {rank} < r.m THEN r.b.lo WHEN {rank} >= r.h THEN r.b.hi ELSE get(r.c.inner, int({rank} - r.m)) END"

        lo, hi, size = "r.b.lo", "r.b.hi", "0D"
        values = f", 'v', {at('r.r0')}, 'w', {at('r.r1')}"
    else:
        first, last = f"((r.r0 - r.m) / r.c.mid * {_STEPS})", f"((r.r1 + 1 - r.m) / r.c.mid * {_STEPS})"
        alone = "r.r1 < r.m OR r.r0 >= r.h"
        lo = f"""CASE WHEN r.r1 < r.m THEN r.b.lo WHEN r.r0 >= r.h THEN r.b.hi WHEN {first} < 1 THEN r.b.lo
          ELSE get(r.c.inner, int(floor({first})) - 1) END"""
        hi = f"""CASE WHEN r.r1 < r.m THEN r.b.lo WHEN r.r0 >= r.h OR {last} > {_STEPS - 1} THEN r.b.hi
          ELSE get(r.c.inner, int(ceil({last})) + 1) END"""
        size = f"CASE WHEN {alone} OR r.c.mid = 0 THEN 0D ELSE r.c.mid * {5.0 / _STEPS + 2.0 / accuracy!r}D END"
        values = ""
    moved = f"""transform({placed}, r -> named_struct('i', r.b.i, 'p', r.b.p, 'n', r.b.n,
      'lo', CASE WHEN {late} THEN r.b.hi WHEN {early} THEN NULL ELSE {lo} END,
      'hi', CASE WHEN {early} THEN r.b.lo WHEN {late} THEN NULL ELSE {hi} END,
      'size', CASE WHEN r.b.n = 0 THEN 0D WHEN {early} OR {late} THEN r.b.n ELSE {size} END{values}))"""
    return found.select(*[col(k) for k in by], F.expr(moved).alias("_s"))


def quantiles_wide(
    df: DataFrame,
    measures: Sequence[str],
    named_probs: dict[str, float],
    by: Sequence[str] = (),
    accuracy: int = 10000,
) -> DataFrame:
    """`exact_quantiles` with one row per (by, variable) and one column per named probability."""
    long = exact_quantiles(df, measures, list(named_probs.values()), by, accuracy)
    keys = [*by, "variable"]
    return long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("quantile"))).alias(n)
          for n, p in named_probs.items()]
    )


def any_true(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags)


def all_true(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, flags)


def total(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def complete_case_filter(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Rows without a null in the given columns.

    One condition per column: the single many-column predicate of `na.drop` makes the optimizer derive a
    version of it for every combination of renamed columns above it.
    """
    return df.where(all_true([col(c).isNotNull() for c in needed]))
