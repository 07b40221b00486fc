"""The same facts in both sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkcohort.operators import concordance

# school column: hospital column
SAME = {"female": "hospital_female", "ethnicgroup": "hospital_ethnicgroup"}


def compare_demographics(spine: DataFrame, school: DataFrame, hospital: DataFrame) -> DataFrame:
    """Pairs of values of linked people: sex and ethnic group in school records (a) and hospital records (b).

    ``school`` is keyed by pmr, ``hospital`` by tpid, one row each; the spine links them.
    """
    linked = spine.filter(F.col("pmr").isNotNull() & F.col("tpid").isNotNull()).select("pmr", "tpid")
    a = school.join(linked.select("pmr").distinct(), "pmr", "left_semi").select("pmr", *SAME)
    b = hospital.join(linked, "tpid").select("pmr", *[F.col(h).alias(c) for c, h in SAME.items()])
    return concordance(a, b, "pmr", list(SAME))
