"""URL filters: listed rules first, logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcohort.llm.common import ascii_lower, cut, let

MAX_LABELLED = 4_000  # labelled urls the model is fitted on, at most
FEATURES = 1 << 13
GRAMS = (2, 3, 4)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without a host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def apply_rules(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as ``struct<rule, allow>``, or NULL.

    A rule fits its host and all subdomains where the path starts with the rule's.
    """
    out = F.lit(None).cast("struct<rule: string, allow: boolean>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is tested first, being outermost
        on_host = (host == r.host) | F.endswith(host, F.lit("." + r.host))
        out = F.when(on_host & F.startswith(path, F.lit(r.path)), F.struct(F.lit(r.name).alias("rule"), F.lit(r.allow).alias("allow"))).otherwise(out)
    return out


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, each marked with where it is from; also the shorter ones at the end."""

    def of(text: Column, mark: str) -> Column:
        cut_up = lambda n: lambda chars: F.transform(chars, lambda _, i: F.concat(F.lit(mark), F.array_join(F.slice(chars, i + 1, n), "")))
        return let(F.split(text, ""), lambda chars: F.concat(*[cut_up(n)(chars) for n in GRAMS]))

    return F.concat(of(F.concat(F.lit("^"), host, F.lit("$")), "h:"), of(path, "p:"))


@dataclass
class UrlFilter:
    """Rules and the fitted model; without labels of both kinds, the only known verdict (allow if none)."""

    rules: Sequence[Rule]
    model: PipelineModel | None
    only: bool = True

    @classmethod
    def fit(cls, labelled: DataFrame, rules: Sequence[Rule], max_labelled: int = MAX_LABELLED) -> UrlFilter:
        """``labelled``: host, path, allow (boolean). Beyond ``max_labelled`` distinct urls, those with the smallest hashes are used."""
        rows = labelled.filter(F.col("allow").isNotNull()).select("host", "path", "allow").distinct()
        rows = cut(rows.orderBy(F.xxhash64("host", "path", "allow"), "host", "path", "allow").limit(max_labelled), "labelled")
        kinds = [r[0] for r in rows.select("allow").distinct().collect()]
        if len(kinds) < 2:
            return cls(rules, None, kinds[0] if kinds else True)
        n = rows.groupBy("allow").count().collect()
        total, count = sum(r["count"] for r in n), {r["allow"]: r["count"] for r in n}
        train = rows.select(
            F.col("allow").cast("double").alias("label"), grams(F.col("host"), F.col("path")).alias("grams"),
            F.when(F.col("allow"), total / 2 / count[True]).otherwise(total / 2 / count[False]).alias("w"),
        ).coalesce(1)
        steps = [
            HashingTF(numFeatures=FEATURES, inputCol="grams", outputCol="features"),
            LogisticRegression(maxIter=25, regParam=0.01, weightCol="w"),
        ]
        return cls(rules, Pipeline(stages=steps).fit(train))

    def judge(self, pages: DataFrame) -> DataFrame:
        """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url).

        A NULL url, or one without ``://``, has an empty host and path and gets the
        model's verdict. Repeated rows are judged each; further columns are ignored.
        """
        rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        rows = rows.withColumn("hit", apply_rules(F.col("host"), F.col("path"), self.rules))
        if self.model is None:
            learned = F.lit(self.only)
        else:
            rows = self.model.transform(rows.withColumn("grams", grams(F.col("host"), F.col("path"))))
            learned = F.col("prediction") > 0.5
        allow = F.coalesce(F.col("hit.allow"), learned)
        return rows.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.when(allow, "allow").otherwise("block").alias("verdict"))


def labelled_by_rules(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """host, path, allow of the urls that a rule decides: the small labelled table where none is given."""
    rows = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return rows.select("host", "path", apply_rules(F.col("host"), F.col("path"), rules)["allow"].alias("allow")).filter(F.col("allow").isNotNull())
