"""Clinical codes: wide code columns to long rows, codelist matching by prefix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.operators.reshape import melt

SEPARATOR = "\u0001"  # between packed codes; no coding system uses it


def melt_codes(
    df: DataFrame, ids: Sequence[str], code_cols: Sequence[str], truncate: int | None = 4
) -> DataFrame:
    """One row per non-blank code with ``code_type``, ``code_no`` and the (cut) code.

    Type and position come from the column name: ``diag_03`` is diag, 3. Only the
    code columns are expanded, and blanks are filtered in the same stage.
    """
    long = melt(df, ids, code_cols, "field", "code")
    return long.withColumns({
        "code_type": F.regexp_replace("field", "_[0-9].*", ""),
        "code_no": F.regexp_extract("field", "([0-9]+)$", 1).cast("int"),
        "code": F.substring("code", 1, truncate) if truncate else F.col("code"),
    }).drop("field")


def pack_codes(code_cols: Sequence[str]) -> Column:
    """All code columns of a row as one text, positions kept, blanks after the last code cut.

    Dozens of mostly blank columns become one short one, so that distinct, joins
    and shuffles of episodes stay narrow.
    """
    texts = ", ".join(f"coalesce(`{c}`, '')" for c in code_cols)
    return F.rtrim(F.expr(f"concat_ws('{SEPARATOR}', {texts})"), F.lit(SEPARATOR))


def unpack_codes(
    df: DataFrame, ids: Sequence[str], packed: str, families: Mapping[str, int], truncate: int | None = 4
) -> DataFrame:
    """The long form of packed codes, as :func:`melt_codes` gives it.

    ``families`` are the code types in packing order with their numbers of columns.
    """
    long = df.select(*ids, F.posexplode(F.split(packed, SEPARATOR)).alias("_pos", "code")).filter(F.col("code") != "")
    kind, number, start = F.lit(None).cast("string"), F.lit(None).cast("int"), 0
    for name, n in families.items():
        here = F.col("_pos") >= start
        kind, number = F.when(here, F.lit(name)).otherwise(kind), F.when(here, F.col("_pos") + 1 - start).otherwise(number)
        start += n
    code = F.substring("code", 1, truncate) if truncate else F.col("code")
    return long.select(*ids, code.alias("code"), kind.alias("code_type"), number.alias("code_no"))


def prefixes(code: Column | str, lengths: Sequence[int]) -> Column:
    """The code's first k characters for each k, of those lengths that it has."""
    c = F.col(code) if isinstance(code, str) else code
    return F.filter(F.array(*[F.when(F.length(c) >= k, F.substring(c, 1, k)) for k in sorted(set(lengths))]), lambda p: p.isNotNull())


def match_codes(
    df: DataFrame,
    codes: DataFrame,
    attrs: Sequence[str],
    code_col: str = "code",
    lengths: Sequence[int] = (3, 4),
    matched: str = "matched_code",
) -> DataFrame:
    """Rows whose code starts with a codelist entry, with the entry's attributes.

    Entries are compared by equality with the code's first k characters, for each
    k in ``lengths``; a longer entry overrides a shorter one. An entry listed
    several times yields a row per listing.

    Rows are read once whatever the lengths, and joined once: entries that begin
    alike, with the shortest length's characters, are one row of the lookup, in
    which each row's prefixes are looked up. The optimizer broadcasts it where the
    codelist's size allows and shuffles otherwise. Rows are neither expanded nor
    grouped, so no task holds more of them than a join does.
    """
    lengths = sorted(set(lengths), reverse=True)
    entries = codes.filter(F.length("code").isin(lengths)).groupBy(F.col("code").alias("_entry"))
    entries = entries.agg(F.collect_list(F.struct(F.lit(0).alias("_"), *attrs)).alias("_listed"))
    starts = entries.groupBy(F.substring("_entry", 1, lengths[-1]).alias("_start"))
    starts = starts.agg(F.map_from_entries(F.collect_list(F.struct("_entry", "_listed"))).alias("_of_start"))

    def looked_up(k: int) -> Column:
        prefix = F.substring(code_col, 1, k)
        listed = F.try_element_at("_of_start", prefix)
        return F.when(listed.isNotNull(), F.struct(prefix.alias("_entry"), listed.alias("_listed")))

    found = df.join(starts, F.substring(code_col, 1, lengths[-1]) == F.col("_start")).withColumn("_best", F.coalesce(*map(looked_up, lengths)))
    found = found.filter(F.col("_best").isNotNull()).select(*df.columns, "_best._entry", "_best._listed")
    found = found.withColumn("_listing", F.explode("_listed"))
    return found.select(*df.columns, F.col("_entry").alias(matched), *[F.col("_listing")[a].alias(a) for a in attrs])


def any_codes(
    df: DataFrame, packed: str, lists: Mapping[str, tuple[DataFrame, Sequence[int]]], keys: Sequence[str]
) -> DataFrame:
    """Flag rows having any code of each list among their packed codes.

    ``lists`` gives for each flag the codelist and the lengths at which an entry is
    compared with the beginning of a code. The distinct prefixes of a row's codes
    are expanded once and joined to the entries by equality, however many there are
    of either; only hits are kept, and a flag applies to every row that shares
    ``keys``, a missing key being a key.
    """
    tagged = [codes.select(F.lit(n).alias("_list"), F.col("code").alias("_c")).filter(F.length("_c").isin(list(k))) for n, (codes, k) in lists.items()]
    entries = reduce(DataFrame.unionByName, tagged).groupBy("_c").agg(*[F.bool_or(F.col("_list") == n).alias(f"_in_{n}") for n in lists])
    lengths = [k for _, of in lists.values() for k in of]
    compared = F.array_distinct(F.flatten(F.transform(F.split(packed, SEPARATOR), lambda c: prefixes(c, lengths))))
    found = df.select(*keys, F.explode(compared).alias("_prefix")).join(entries, F.col("_prefix") == F.col("_c"))
    hits = found.groupBy(*[F.col(c).alias(f"_key_{c}") for c in keys])
    hits = hits.agg(*[F.bool_or(f"_in_{n}").alias(f"_in_{n}") for n in lists])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys])
    out = df.join(hits, same, "left").withColumns({n: F.coalesce(f"_in_{n}", F.lit(False)) for n in lists})
    return out.select(*df.columns, *lists)


def any_code(
    df: DataFrame, out: str, packed: str, codes: DataFrame, keys: Sequence[str], lengths: Sequence[int] = (3, 4)
) -> DataFrame:
    """:func:`any_codes` for one list."""
    return any_codes(df, packed, {out: (codes, lengths)}, keys)
