"""Many rows per person in, one row per person out.

Every reduction is a plain aggregate or a ``row_number() == 1`` filter. Both
shrink each key inside the map tasks (partial aggregation, window group limit),
so a person who holds a third of all rows sends only a handful of rows per task
through the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkcohort.functions.values import as_col, max_or_null

Keys = str | Sequence[str]


def key_list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def first_per(df: DataFrame, keys: Keys, order_by: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in a stated order.

    The order must be total for the result to be determined; name enough columns.
    """
    keys = key_list(keys)
    w = Window.partitionBy(*keys).orderBy(*[as_col(c) for c in order_by])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest(df: DataFrame, keys: Keys, cols: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Values on the most recent row of each key (NULL if that row has NULL)."""
    keys = key_list(keys)
    names = list(dict.fromkeys([*keys, *cols, *order_by]))
    last = first_per(df.select(*names), keys, [F.col(c).desc() for c in order_by])
    return last.select(*keys, *cols)


def modal(
    df: DataFrame,
    key: str,
    cols: Sequence[str],
    ties: str = "smallest",
    order_by: Sequence[str] = (),
    seed: int = 0,
) -> DataFrame:
    """Most frequent non-NULL value of each column per key; NULL if there is none.

    ties: ``smallest`` value; ``hash`` draws by the MD5 of key, value and ``seed``,
    so repeatably and alike on any engine; ``last`` falls back to the key's last non-NULL value by ``order_by``.

    Rows are first counted by key and all values together, of which a key has few
    combinations; grouping sets then give the counts of each column's values, and
    a last aggregate picks. Each step is partial before its shuffle.
    """
    if ties not in ("smallest", "hash", "last"):
        raise ValueError(f"unknown tie rule {ties!r}")
    if ties == "last" and not order_by:
        raise ValueError("ties='last' needs order_by")
    src = df.select(F.col(key), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)],
                    *([F.struct(*order_by).alias("_at")] if ties == "last" else []))
    vals = [f"_v{i}" for i in range(len(cols))]
    last_seen = [F.max("_at").alias("_at")] if ties == "last" else []
    counted = src.groupBy(key, *vals).agg(F.count(F.lit(1)).alias("_n"), *last_seen)
    if len(vals) == 1:
        counted = counted.withColumn(f"_g{vals[0]}", F.lit(0))
    else:
        groups = [F.grouping(v).alias(f"_g{v}") for v in vals]
        counted = counted.groupingSets([[key, v] for v in vals], key, *vals).agg(F.sum("_n").alias("_n"), *last_seen, *groups)

    def pick(v: str) -> Column:
        here = (F.col(f"_g{v}") == 0) & F.col(v).isNotNull()
        n = F.col("_n")
        if ties == "hash":
            draw = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col(v).cast("string"), F.lit(str(seed))))
            rank = F.struct((-n).alias("n"), draw.alias("h"), F.col(v).alias("v"))
            return F.min(F.when(here, rank))["v"]
        low = F.min(F.when(here, F.struct((-n).alias("n"), F.col(v).alias("v"))))["v"]
        if ties == "smallest":
            return low
        high = F.max(F.when(here, F.struct(n.alias("n"), F.col(v).alias("v"))))["v"]
        last = F.max(F.when(here, F.struct(F.col("_at").alias("at"), F.col(v).alias("v"))))["v"]
        return F.when(low == high, low).otherwise(last)

    return counted.groupBy(key).agg(*[pick(v).alias(c) for v, c in zip(vals, cols)])


def ever(df: DataFrame, keys: Keys, cols: Sequence[str], strict_nulls: bool = False) -> DataFrame:
    """Largest value ("ever") of each column per key.

    ``strict_nulls`` makes the result NULL as soon as one value is NULL.
    """
    reduce_one = max_or_null if strict_nulls else F.max
    return df.groupBy(*key_list(keys)).agg(*[reduce_one(c).alias(c) for c in cols])


def highest(
    df: DataFrame,
    key: str,
    levels: Sequence[tuple[str, Column]],
    out: str,
    none: str | None = None,
) -> DataFrame:
    """Highest level each key ever reaches; ``levels`` run from lowest to highest.

    Keys whose rows meet no level get ``none``.
    """
    rank = F.lit(0)
    for i, (_, cond) in enumerate(levels, start=1):
        rank = F.when(cond, F.lit(i)).otherwise(rank)
    labels = F.array(F.lit(none), *[F.lit(label) for label, _ in levels])
    top = df.groupBy(key).agg(F.max(rank).alias("_r"))
    return top.select(key, F.element_at(labels, F.col("_r") + 1).alias(out))


def resolve(
    df: DataFrame,
    key: str,
    cols: Sequence[str],
    on_conflict: str | Mapping[str, str] = "null",
    order_by: Sequence[str] = (),
    where: Column | None = None,
    unless: Column | None = None,
) -> DataFrame:
    """One row per key holding each column's single non-NULL value.

    Where a key has several distinct values the column's policy decides: ``drop``
    the key, ``null`` the value, or keep the ``first`` row's value by ``order_by``.

    Only rows meeting ``where`` count, and a key with any row meeting ``unless``
    is left out; both are settled in the same aggregate.
    """
    policy = {c: on_conflict if isinstance(on_conflict, str) else on_conflict[c] for c in cols}
    kept = [c for c in cols if policy[c] == "first"]
    if kept and not order_by:
        raise ValueError("policy 'first' needs order_by")

    def counted(c: Column) -> Column:
        return c if where is None else F.when(where, c)

    measures = []
    for c in cols:
        measures += [F.min(counted(F.col(c))).alias(f"_lo_{c}"), F.max(counted(F.col(c))).alias(f"_hi_{c}")]
    if kept:
        row = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order_by)], *kept)
        measures.append(F.min(counted(row)).alias("_first"))
    keep = []
    if where is not None:
        measures.append(F.bool_or(where).alias("_counted"))
        keep.append(F.col("_counted"))
    if unless is not None:
        measures.append(F.coalesce(F.bool_or(unless), F.lit(False)).alias("_barred"))
        keep.append(~F.col("_barred"))
    g = df.groupBy(key).agg(*measures)
    out = []
    for c in cols:
        same = F.col(f"_lo_{c}").eqNullSafe(F.col(f"_hi_{c}"))
        if policy[c] == "drop":
            keep.append(same)
        other = F.col("_first")[c] if policy[c] == "first" else F.lit(None)
        out.append(F.when(same, F.col(f"_lo_{c}")).otherwise(other).alias(c))
    for cond in keep:
        g = g.filter(cond)
    return g.select(key, *out)


def any_in_group(df: DataFrame, keys: Keys, flags: Mapping[str, Column]) -> DataFrame:
    """Give every row of a group whether any row of it meets a condition.

    Aggregates first and joins back, rather than a window over whole groups, so
    that a hot group is split like any skewed join side.
    """
    keys = key_list(keys)
    hits = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        *[F.coalesce(F.bool_or(cond), F.lit(False)).alias(name) for name, cond in flags.items()]
    )
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return df.join(hits, cond, "left").drop(*[f"_k_{k}" for k in keys])


def first_date(df: DataFrame, key: str, date: str, out: str, where: Column | None = None) -> DataFrame:
    """Earliest date per key, among rows meeting ``where`` if given."""
    d = F.col(date) if where is None else F.when(where, F.col(date))
    return df.groupBy(key).agg(F.min(d).alias(out))


def pooled_modal(frames: Sequence[DataFrame], key: str, cols: Sequence[str], **how) -> DataFrame:
    """Modal values over several sources taken together."""
    from linkcohort.sources.harmonise import union_all

    return modal(union_all([f.select(key, *cols) for f in frames]), key, cols, **how)


def first_clear_event(
    df: DataFrame, on: str, date: str, clear_days: int, lo: Column | None = None, hi: Column | None = None, out: str = "index_date"
) -> DataFrame:
    """Each person's first event in [lo, hi) with no other event in the ``clear_days`` days before it.

    Earlier events count against one whether they lie in the window or not, and
    whether they qualify themselves; events of one day are one. Rows are first
    reduced to days, which the calendar bounds, so a person with very many rows
    is put in order by a few. Persons without such an event have no row.
    """
    days = df.filter(F.col(on).isNotNull() & F.col(date).isNotNull()).select(on, date).distinct()
    before = F.lag(date).over(Window.partitionBy(on).orderBy(date))
    clear = F.coalesce(F.datediff(F.col(date), before) > clear_days, F.lit(True))
    inside = F.lit(True) if lo is None else F.col(date) >= lo
    inside = inside if hi is None else inside & (F.col(date) < hi)
    return days.withColumn("_clear", clear).filter(F.col("_clear") & inside).groupBy(on).agg(F.min(date).alias(out))


def weighted_modal(df: DataFrame, on: str, cols: Sequence[str], weight: Column | str) -> DataFrame:
    """Each person's value of greatest summed weight, per column; the smallest of several.

    NULL values and weights, and weights of 0 or less, are no evidence; a person
    without any has NULL. Weights are summed by person and value before anything
    is compared, so a person with very many rows reaches the comparison with one
    row per value. Doubles are summed in no fixed order: give weights as decimals
    or whole numbers where ties matter.
    """
    w = F.col(weight) if isinstance(weight, str) else weight
    long = df.select(on, w.alias("_weight"), *cols)
    out = df.select(on).filter(F.col(on).isNotNull()).distinct()
    for c in cols:
        sums = long.filter(F.col(on).isNotNull() & F.col(c).isNotNull() & (F.col("_weight") > 0)).groupBy(on, c).agg(F.sum("_weight").alias("_weight"))
        best = sums.groupBy(on).agg(F.min(F.struct((-F.col("_weight")).alias("less"), F.col(c).alias("value"))).alias("_best"))
        out = out.join(best.select(on, F.col("_best.value").alias(c)), on, "left")
    return out


def dense_rank_in(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Dense rank of a date within its key, on every row.

    Ranks the distinct dates only, then joins back: the ranked group is bounded by
    the calendar, not by the rows of the key. Other types have no such bound and
    are an error.
    """
    if df.schema[value].dataType.typeName() != "date":
        raise ValueError(f"{value!r} is no date, so the number of its values has no bound")
    seen = df.select(F.col(key).alias("_k"), F.col(value).alias("_v")).distinct()
    ranked = seen.withColumn(out, F.dense_rank().over(Window.partitionBy("_k").orderBy("_v")))
    on = F.col(key).eqNullSafe(F.col("_k")) & F.col(value).eqNullSafe(F.col("_v"))
    return df.join(ranked, on, "left").drop("_k", "_v")


def number_rows(df: DataFrame, key: str, date: str, order_by: str, out: str, cells: int = 1024) -> DataFrame:
    """1, 2, 3, … within each key by date, then by a whole-number column.

    Rows are numbered within cells, to which the rows of earlier cells are added:
    each date of a key is cut into up to ``cells`` equal ranges of ``order_by``. So
    a key, or one day of it, however large, is shared among tasks. Where only the
    first row is wanted, :func:`first_per` does far less.
    """
    whole = "decimal(38,0)"  # differences of 64-bit numbers, times the cells, stay within it
    per_day = df.groupBy(F.col(key).alias("_k"), F.col(date).alias("_d")).agg(
        F.min(order_by).cast(whole).alias("_lo"), F.max(order_by).cast(whole).alias("_hi")
    )
    same_day = F.col(key).eqNullSafe(F.col("_k")) & F.col(date).eqNullSafe(F.col("_d"))
    wide = f"least(_hi - _lo + 1, {cells})"
    cell = F.expr(f"cast(((cast({order_by} AS {whole}) - _lo) * {wide}) div (_hi - _lo + 1) AS int)")
    rows = df.join(per_day, same_day, "left").withColumn("_cell", cell).drop("_k", "_d", "_lo", "_hi")

    counts = rows.groupBy(F.col(key).alias("_k"), F.col(date).alias("_d"), F.col("_cell").alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    # days times cells of a key, however many rows they hold
    earlier = Window.partitionBy("_k").orderBy("_d", "_c").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_k", "_d", "_c", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    same_cell = same_day & F.col("_cell").eqNullSafe(F.col("_c"))
    within = F.row_number().over(Window.partitionBy(key, date, "_cell").orderBy(order_by))
    return rows.join(offsets, same_cell, "left").withColumn(out, (F.col("_before") + within).cast("int")).drop(
        "_k", "_d", "_c", "_cell", "_before"
    )


def run_id(df: DataFrame, key: str, date: str, value: str, out: str) -> DataFrame:
    """Number the runs of equal consecutive values of ``value`` within a key.

    One value per (key, date) is expected, the smallest is taken otherwise; the
    runs are then found on the calendar-bounded dates of each key.
    """
    days = df.groupBy(F.col(key).alias("_k"), F.col(date).alias("_d")).agg(F.min(value).alias("_v"))
    w = Window.partitionBy("_k").orderBy("_d")
    days = days.withColumn("_new", (~F.col("_v").eqNullSafe(F.lag("_v").over(w)) | (F.row_number().over(w) == 1)).cast("int"))
    days = days.withColumn(out, F.sum("_new").over(w).cast("int")).select("_k", "_d", out)
    on = F.col(key).eqNullSafe(F.col("_k")) & F.col(date).eqNullSafe(F.col("_d"))
    return df.join(days, on, "left").drop("_k", "_d")
