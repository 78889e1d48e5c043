"""Row statistics over a fixed list of columns, tests and global ranks.

Row statistics are plain arithmetic, so they stay inside generated code. Global ranks are computed in buckets of values whose bounds
come from approximate quantiles: rows are ordered inside buckets and only one number for each bucket is ordered globally.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.staging import staged

BUCKETS = 64


def total(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def mean(cols: list[Column]) -> Column:
    return total(cols) / float(len(cols))


def variance(cols: list[Column]) -> Column:
    """Sample variance; 0 of a single value."""
    if len(cols) < 2:
        return F.lit(0.0)
    m = mean(cols)
    return total([(c - m) * (c - m) for c in cols]) / float(len(cols) - 1)


def deviation(cols: list[Column]) -> Column:
    return F.sqrt(variance(cols))


def median_of(cols: list[Column]) -> Column:
    """Median of the values that aren't null."""
    s = F.sort_array(F.filter(F.array(*cols), lambda x: x.isNotNull()))
    n = F.size(s)
    low, high = F.get(s, F.floor((n - 1) / 2).cast("int")), F.get(s, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2.0)


def mad(cols: list[Column]) -> Column:
    m = median_of(cols)
    return median_of([F.abs(c - m) for c in cols])


def t_test(average: Column, deviation_: Column, n: int) -> Column:
    """Two-sided p of a one-sample t-test against 0, by the finite series for whole degrees of freedom; 1 without variation."""
    if n < 2:
        return F.lit(1.0)
    v = n - 1
    angle = F.atan(F.abs(average / (deviation_ / math.sqrt(n))) / math.sqrt(v))
    s, c = F.sin(angle), F.cos(angle)
    if v % 2:
        terms, factor, power = [], 1.0, c
        for k in range(1, v - 1, 2):
            terms.append(power * factor)
            factor *= (k + 1) / (k + 2)
            power = power * c * c
        inner = angle + s * total(terms) if terms else angle
        p = 1.0 - inner * (2.0 / math.pi)
    else:
        terms, factor, power = [F.lit(1.0)], 1.0, c * c
        for k in range(1, v - 2, 2):
            factor *= k / (k + 1)
            terms.append(power * factor)
            power = power * c * c
        p = 1.0 - s * total(terms)
    return F.when(deviation_ > 0, F.greatest(p, F.lit(0.0))).otherwise(F.lit(1.0))


def counted(df: DataFrame, value: str) -> DataFrame:
    """df with below (rows of a smaller value), ties (rows of the same) and rows (of any value); rows without a value get nulls."""
    df = staged(df)
    values = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    bounds = df.agg(F.percentile_approx(value, F.array(*[F.lit(i / BUCKETS) for i in range(1, BUCKETS)]), 1000).alias("_bounds"))
    placed = values.crossJoin(F.broadcast(bounds)).withColumn("_bucket", F.size(F.filter("_bounds", lambda b: b < F.col("_v")))).drop("_bounds")  # one row of bounds
    sums = placed.groupBy("_bucket").agg(F.sum("_n").alias("_sum"))
    every = Window.orderBy("_bucket")  # BUCKETS rows
    before = sums.select("_bucket", (F.sum("_sum").over(every) - F.col("_sum")).alias("_before"), F.sum("_sum").over(Window.partitionBy()).alias("rows"))
    inside = Window.partitionBy("_bucket").orderBy("_v")
    ranks = placed.join(F.broadcast(before), "_bucket").select(
        "_v", (F.col("_before") + F.sum("_n").over(inside) - F.col("_n")).alias("below"), F.col("_n").alias("ties"), "rows", "_bucket"
    )
    return df.join(ranks, df[value] == ranks["_v"], "left").drop("_v", "_bucket")


def percent_of_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """df with 100 * average rank / rows, 100 for the greatest value."""
    out = counted(df, value)
    return out.withColumn(name, 100.0 * (F.col("below") + (F.col("ties") + 1) / 2.0) / F.col("rows")).drop("below", "ties", "rows")


def false_discovery(df: DataFrame, p: str, name: str) -> DataFrame:
    """df with Benjamini-Hochberg q-values; a null p counts as 1."""
    filled = df.withColumn("_p", F.coalesce(F.col(p), F.lit(1.0)))
    values = counted(filled.select("_p").withColumn("_one", F.lit(1)), "_p").select("_p", (F.col("_p") * F.col("rows") / (F.col("below") + F.col("ties"))).alias("_raw")).distinct()
    bounds = filled.agg(F.percentile_approx("_p", F.array(*[F.lit(i / BUCKETS) for i in range(1, BUCKETS)]), 1000).alias("_bounds"))
    placed = values.crossJoin(F.broadcast(bounds)).withColumn("_bucket", F.size(F.filter("_bounds", lambda b: b < F.col("_p")))).drop("_bounds")
    least = placed.groupBy("_bucket").agg(F.min("_raw").alias("_least"))
    above = least.select("_bucket", F.min("_least").over(Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)).alias("_above"))
    inside = Window.partitionBy("_bucket").orderBy(F.desc("_p"))
    q = placed.join(F.broadcast(above), "_bucket").select("_p", F.least(F.min("_raw").over(inside), F.col("_above"), F.lit(1.0)).alias(name))
    return filled.join(q, "_p").drop("_p")


SKETCH = 10_000  # accuracy of the brackets that exact quantiles are looked for in


def quantiles(df: DataFrame, wanted: dict[str, tuple[Column | str, float]], by: tuple[str, ...] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation: a row for each group, with a column for each name of wanted (a value and a share). Nulls and NaN don't count.

    Two passes for all columns, shares and groups together. A sketch gives each wanted rank a bracket of values that holds about 1 / 1,000 of the rows; then values below the
    bracket are only counted, and values in it are counted by value and ordered. So no task sees a column whole, and a common value is one row. df is read twice: stage it if it is costly.
    Without groups there is always one row, of nulls where a column has no values; a group has a row if any of its values counts.
    """
    columns: dict[str, Column] = {}
    names = []
    for name, (value, share) in wanted.items():
        value = F.col(value) if isinstance(value, str) else value
        at = list(columns).index(str(value)) if str(value) in columns else len(columns)
        columns[str(value)] = value
        names.append((name, at, share))
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    long = df.select(key.alias("_k"), F.posexplode(F.array(*[c.cast("double") for c in columns.values()])).alias("_c", "_v")).filter("_v is not null and not isnan(_v)")
    near = 4.0 / SKETCH
    edges = sorted({min(1.0, max(0.0, s + d)) for _, _, s in names for d in (-near, near)})
    facts = long.groupBy("_k", "_c").agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", F.array(*map(F.lit, edges)), SKETCH).alias("_e"))
    place = lambda s, d: F.get("_e", F.lit(edges.index(min(1.0, max(0.0, s + d)))))
    asked = [F.struct(F.lit(k).alias("q"), F.lit(at).alias("c"), F.lit(s).alias("p"), place(s, -near).alias("low"), place(s, near).alias("high")) for k, (_, at, s) in enumerate(names)]
    brackets = facts.select("_k", "_c", "_n", F.explode(F.filter(F.array(*asked), lambda x: x["c"] == F.col("_c"))).alias("_x"))
    rank = (F.col("_n") - 1) * F.col("_x.p")
    brackets = brackets.select("_k", "_c", F.col("_x.q").alias("_q"), F.col("_x.low").alias("_low"), F.col("_x.high").alias("_high"), F.floor(rank).alias("_r"), (rank - F.floor(rank)).alias("_f"))

    def found(brackets: DataFrame) -> DataFrame:
        """The values at ranks _r and _r + 1, null where the bracket doesn't hold them."""
        inside = F.when((F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")), F.col("_v"))
        met = long.join(brackets, ["_k", "_c"]).filter("_v <= _high").groupBy("_k", "_q", inside.alias("_v")).agg(F.count(F.lit(1)).alias("_m"), F.first("_r").alias("_r"), F.first("_f").alias("_f"))
        upto = F.sum("_m").over(Window.partitionBy("_k", "_q").orderBy(F.asc_nulls_first("_v")))
        placed = met.withColumn("_to", upto).filter(F.col("_v").isNotNull())
        at = lambda d: F.min(F.when((F.col("_to") - F.col("_m") <= F.col("_r") + d) & (F.col("_r") + d < F.col("_to")), F.col("_v")))
        return placed.groupBy("_k", "_q").agg(at(0).alias("_a"), at(1).alias("_b"), F.first("_f").alias("_f"))

    brackets = staged(brackets)  # a table of known size: small ones are broadcast by the planner
    both = staged(found(brackets))
    lost = F.col("_a").isNull() | (F.col("_f") > 0) & F.col("_b").isNull()
    if not (missed := both.filter(lost)).isEmpty():  # the sketch promises brackets that hold; else all values of the column are ordered
        wide = brackets.join(missed.select("_k", "_q"), ["_k", "_q"]).withColumns({"_low": F.lit(-math.inf), "_high": F.lit(math.inf)})
        both = both.filter(~lost).unionByName(found(staged(wide)))
    value = F.when(F.col("_f") > 0, F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")).otherwise(F.col("_a"))
    one = lambda k, name: F.max(F.when(F.col("_q") == k, F.col("_x"))).alias(name)
    rows = both.withColumn("_x", value)
    results = [one(k, name) for k, (name, _, _) in enumerate(names)]
    if not by:
        return rows.agg(*results)
    return rows.groupBy("_k").agg(*results).select(*[F.col(f"_k.{b}").alias(b) for b in by], *[n for n, _, _ in names])


def absolute_deviation(df: DataFrame, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """A row for each group: mad_<column>, the median distance of a column's values from their median."""
    middle = quantiles(df, {f"_m_{c}": (c, 0.5) for c in columns}, by)
    if by:
        away = df.join(staged(middle), list(by))
    else:
        away = df.crossJoin(F.broadcast(middle))  # one row
    return quantiles(away, {f"mad_{c}": (F.abs(F.col(c) - F.col(f"_m_{c}")), 0.5) for c in columns}, by)
