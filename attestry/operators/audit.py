"""One audit of provenance for all that take deduplicated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def audit(unique: DataFrame, occurrences: DataFrame, fingerprint: str = "fingerprint", position: str = "input_position", same: tuple[str, ...] = ()) -> DataFrame:
    """(fingerprint, problem), empty for a sound pair.

    Each unique row has occurrences and each occurrence a unique row; the representative is the first occurrence of its
    fingerprint and stands at the unique row's position; the columns in `same` agree between the two.
    """
    per = occurrences.groupBy(F.col(fingerprint).alias("o_fp")).agg(F.min(position).alias("first"), F.min("representative_position").alias("low"), F.max("representative_position").alias("high"))
    both = unique.groupBy(F.col(fingerprint).alias("u_fp")).agg(F.min(position).alias("at"), F.count(F.lit(1)).alias("n")).join(per, F.col("u_fp") == F.col("o_fp"), "full")
    problem = (
        F.when(F.col("o_fp").isNull(), "no_occurrence").when(F.col("u_fp").isNull(), "no_unique_row").when(F.col("n") > 1, "repeated_unique_row")
        .when((F.col("low") != F.col("high")) | (F.col("low") != F.col("first")), "representative_not_first").when(F.col("at") != F.col("first"), "position_differs")
    )
    out = both.select(F.coalesce("u_fp", "o_fp").alias("fingerprint"), problem.alias("problem")).where("problem is not null")
    if same:
        reps = occurrences.where(F.col(position) == F.col("representative_position")).select(F.col(fingerprint).alias("r_fp"), *(F.col(c).alias(f"r_{c}") for c in same))
        differs = ~F.expr(" and ".join(f"`{c}` <=> `r_{c}`" for c in same))
        out = out.unionByName(unique.join(reps, F.col(fingerprint) == F.col("r_fp")).where(differs).select(F.col(fingerprint).alias("fingerprint"), F.lit("provenance_differs").alias("problem")))
    return out
