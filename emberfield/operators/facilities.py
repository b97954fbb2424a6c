"""At-risk facility register."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfield.operators.ordering import number_rows

TEXT_FIELDS = ["facility_name", "facility_address", "suburb", "lga"]


def dedupe_facilities(registers: list[DataFrame], order: list[str], trim_first: bool = False) -> DataFrame:
    """Union of registers; the first row per untrimmed (name, address, suburb); then trimmed and renumbered.

    The key is compared before trimming, so copies that differ in blanks stay, unless ``trim_first``. Each
    register needs the ``order`` columns to define which row is first.
    """
    out = None
    for i, df in enumerate(registers):
        tagged = df.withColumn("_src", F.lit(i))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if trim_first:
        out = out.withColumns({c: F.trim(c) for c in TEXT_FIELDS})
    keys = TEXT_FIELDS[:3]
    rest = [c for c in out.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct("_src", *order))
    unique = out.groupBy(*keys).agg(first.alias("_r")).select(*keys, "_r.*")
    numbered = number_rows(unique, ["_src", *order, *keys], "_id_new")
    return numbered.withColumns({c: F.trim(c) for c in TEXT_FIELDS}).drop("_src", "_id").withColumnRenamed("_id_new", "_id")
