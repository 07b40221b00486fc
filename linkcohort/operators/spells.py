"""Hospital episodes: date repair, joining of admissions into spells, length of stay.

Spells depend on a person's admissions in order, which would put all rows of a
person into one task. Only the admission date, its latest discharge and its
latest episode end matter, so episodes are first aggregated to (person,
admission date). What is then ordered per person is bounded by the number of
calendar days, however many episodes the person has; the bounds are joined back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkcohort.functions.dates import parse_date

# Fixed value: dates up to this day stand for "unknown" in the hospital extracts.
UNKNOWN_DATE = dt.date(1801, 1, 1)


def repair_dates(
    df: DataFrame,
    epistart: str = "epistart",
    epiend: str = "epiend",
    admidate: str = "admidate",
    disdate: str = "disdate",
) -> DataFrame:
    """Usable, ordered episode and admission dates.

    Reads text dates; unknowns become NULL; rows lacking an episode start, an
    episode end or an admission date are dropped; a missing discharge is taken
    from the episode end; both pairs are turned round when discharge precedes
    admission; an episode that still ends before it starts gets the admission's
    dates.
    """
    cols = [epistart, epiend, admidate, disdate]
    order = df.columns

    def clean(c: str) -> Column:
        d = F.col(c) if isinstance(df.schema[c].dataType, T.DateType) else parse_date(F.col(c).cast("string"))
        return F.when(d > F.lit(UNKNOWN_DATE), d)

    out = _derive(df, {c: clean(c) for c in cols})
    out = out.filter(F.col(epistart).isNotNull() & F.col(admidate).isNotNull() & F.col(epiend).isNotNull())
    out = _derive(out, {disdate: F.coalesce(F.col(disdate), F.col(epiend))})
    turned = F.col(admidate) > F.col(disdate)

    def swapped(a: str, b: str) -> Column:
        return F.when(turned, F.col(b)).otherwise(F.col(a))

    out = _derive(out, {
        epistart: swapped(epistart, epiend), epiend: swapped(epiend, epistart),
        admidate: swapped(admidate, disdate), disdate: swapped(disdate, admidate),
    })
    late = F.col(epistart) > F.col(epiend)
    out = _derive(out, {
        epistart: F.when(late, F.col(admidate)).otherwise(F.col(epistart)),
        epiend: F.when(late, F.col(disdate)).otherwise(F.col(epiend)),
    })
    return out.filter(all_present(cols)).select(*order)


def all_present(cols: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in cols))


def _derive(df: DataFrame, cols: Mapping[str, Column]) -> DataFrame:
    """Replace columns by expressions over the old ones, each computed once per row.

    A plain projection would be unfolded into every filter that later steps push
    down, several levels deep. A generator of one row is not.
    """
    row = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select(*[c for c in df.columns if c not in cols], F.inline(F.array(row)))


def spell_bounds(
    df: DataFrame,
    person: str = "tpid",
    mode: str = "merge",
    epiend: str = "epiend",
    admidate: str = "admidate",
    disdate: str = "disdate",
) -> DataFrame:
    """Spell start and end of every (person, admission date).

    ``merge``: admissions that touch or overlap anything before them belong to
    one spell. ``chain``: an admission is compared with the one just before it
    only, and a spell end is the latest discharge from that admission onwards
    in its chain, so a short stay nested in a long one ends the chain.
    """
    if mode not in ("merge", "chain"):
        raise ValueError(f"unknown spell mode {mode!r}")
    adm = df.groupBy(person, F.col(admidate).alias("_adm")).agg(
        F.max(disdate).alias("_dis"), F.max(epiend).alias("_epi"), F.count(F.lit(1)).alias("_n")
    )
    # the count depends on the distinct rows, so both sides of the join in
    # join_spells share one shuffle of them and the extracts are read once
    adm = adm.filter(F.col("_n") > 0)
    by_date = Window.partitionBy(person).orderBy("_adm")
    if mode == "merge":
        before = by_date.rowsBetween(Window.unboundedPreceding, -1)
        adm = adm.withColumn("_new", F.coalesce(F.max("_dis").over(before) < F.col("_adm"), F.lit(True)))
        # the latest opening up to here, in the same order: one sort serves both
        adm = adm.withColumn("spell_start", F.max(F.when(F.col("_new"), F.col("_adm"))).over(by_date))
        adm = adm.withColumn("_end", F.col("_dis"))
    else:
        adm = adm.withColumn("_linked", F.coalesce(F.col("_dis") >= F.lead("_adm").over(by_date), F.lit(False)))
        adm = adm.withColumns({
            "_was": F.coalesce(F.lag("_linked").over(by_date), F.lit(False)),
            "_prev": F.lag("_dis").over(by_date),
        })
        adm = adm.withColumn("_chain", F.sum((~F.col("_was")).cast("int")).over(by_date))
        onwards = Window.partitionBy(person, "_chain").orderBy("_adm").rowsBetween(0, Window.unboundedFollowing)
        adm = adm.withColumn(
            "_end",
            F.when(F.col("_linked"), F.max("_dis").over(onwards))
            # a lone last episode keeps the longer of its own and the previous stay
            .when(F.col("_was") & (F.col("_n") == 1), F.greatest("_dis", "_prev"))
            .otherwise(F.col("_dis")),
        )
        adm = adm.withColumn("spell_start", F.min("_adm").over(Window.partitionBy(person, "_end")))
    spell = Window.partitionBy(person, "spell_start")
    adm = adm.withColumn("spell_end", F.max(F.greatest("_end", "_epi")).over(spell))
    return adm.select(person, F.col("_adm").alias(admidate), "spell_start", "spell_end")


def join_spells(
    df: DataFrame,
    person: str = "tpid",
    mode: str = "merge",
    epiend: str = "epiend",
    admidate: str = "admidate",
    disdate: str = "disdate",
) -> DataFrame:
    """Distinct episodes with the bounds of the spell each belongs to.

    Dates must have been repaired. Rows without a person id belong to no spell
    and are dropped.
    """
    df = df.filter(all_present([person, admidate])).distinct()
    return df.join(spell_bounds(df, person, mode, epiend, admidate, disdate), [person, admidate], "inner")


def los_nights(start: str = "spell_start", end: str = "spell_end") -> Column:
    """Nights between the two ends of a spell."""
    return F.datediff(F.col(end), F.col(start))


def collapse_intervals(df: DataFrame, on: str, start: str, end: str, gap: int = 0, count: str = "n") -> DataFrame:
    """``on``, ``start``, ``end``, ``count``: overlapping intervals of a person as one, with the number of rows in it.

    Intervals also join where at most ``gap`` days lie between them. A NULL end is
    still open, and so is what it joins; an end before its start counts as the
    start; rows without a person or a start are dropped. Rows are first reduced to
    (person, start), which the calendar bounds; only that is put in order.
    """
    open_end = F.lit(dt.date(9999, 12, 31))
    rows = df.filter(F.col(on).isNotNull() & F.col(start).isNotNull())
    days = rows.groupBy(on, start).agg(F.max(F.greatest(F.coalesce(F.col(end), open_end), F.col(start))).alias("_end"), F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(on).orderBy(start)
    reached = F.max("_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    days = days.withColumn("_opens", F.when(F.datediff(F.col(start), reached) <= gap, 0).otherwise(1))
    days = days.withColumn("_period", F.sum("_opens").over(order))
    out = days.groupBy(on, "_period").agg(F.min(start).alias(start), F.max("_end").alias(end), F.sum("_n").alias(count))
    return out.select(on, start, F.nullif(F.col(end), open_end).alias(end), count)
