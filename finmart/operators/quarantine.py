"""Setting rows with unusable identifiers aside instead of dropping them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.functions.ids import id_problem, standardize_id

#: column -> (length, prefix to strip or None)
Rules = dict[str, tuple[int, str | None]]


def _judged(df: DataFrame, rules: Rules) -> DataFrame:
    problems = [F.concat(F.lit(f"{c}: "), id_problem(F.col(c), n, p)) for c, (n, p) in rules.items()]
    return df.withColumn("_quarantine_reason", F.concat_ws("; ", *problems))


def quarantine_split(df: DataFrame, rules: Rules, batch_id: str,
                     at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined): accepted rows have their identifiers standardised
    in place; quarantined ones say why, when and in which batch, and hold the
    raw row as JSON (nulls included).  Both are narrow filters over one scan."""
    judged = _judged(df, rules)
    good = judged.filter("_quarantine_reason = ''").drop("_quarantine_reason")
    good = good.withColumns({c: standardize_id(F.col(c), n, p) for c, (n, p) in rules.items()})
    when = F.lit(at).cast("timestamp_ntz") if at else F.localtimestamp()
    raw = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    bad = judged.filter("_quarantine_reason <> ''").select(
        "_quarantine_reason", when.alias("_quarantined_at"), F.lit(batch_id).alias("_batch_id"),
        raw.alias("_raw_row"))
    return good, bad


def quarantine_counts(quarantined: DataFrame, entity: str) -> DataFrame:
    """Rows per reason; a row count in quarantine warns, it doesn't fail."""
    reason = F.explode(F.split("_quarantine_reason", "; "))
    return (quarantined.select(reason.alias("reason")).groupBy("reason")
            .agg(F.count(F.lit(1)).alias("failures"))
            .select(F.lit(entity).alias("entity"), "reason", "failures", F.lit("warn").alias("status")))
