"""Running the check catalogue.

``check_failures`` returns the failing rows of one check (what a failure
store keeps).  ``run_checks`` returns one summary row per check —
check_id, layer, relation, column_name, check_name, severity, failures,
status — and evaluates all row-level checks of a relation (not_null,
expression_is_true, positive_value) in ONE aggregation pass over it (no
distinct in it, so no row is copied); accepted_values filters the bad values
first and groups those few.  A relation's unscoped uniqueness and combination checks share one
grouping-sets aggregation; relationships count child rows per key before
the anti join.  Every
set-level check contributes (check_id, n) rows to a single map-side-combined
count, so there is one shuffle for all of them instead of one global
aggregate per check.  Nothing is collected: the summary is a DataFrame.  ``count_checks``
takes the same counts relation by relation, where one plan of all is too much for the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from finmart.operators import checks as C
from finmart.plans.catalogue import CATALOGUE, LAYER_OF, Check

ROW_LEVEL = {"not_null", "expression_is_true", "positive_value"}


def _fail_condition(c: Check):
    if c.kind == "not_null":
        cond = C.not_null_fails(c.column)
    elif c.kind == "expression_is_true":
        cond = C.expression_fails(c.args["expression"], c.column)
    elif c.kind == "positive_value":
        cond = C.positive_value_fails(c.column, c.args.get("allow_zero", False))
    else:
        raise ValueError(c.kind)
    return cond & F.coalesce(F.expr(c.where), F.lit(False)) if c.where else cond


def check_failures(c: Check, models) -> DataFrame:
    """Failing rows of one check."""
    rel = models[c.relation]
    if c.kind == "not_null":
        return C.not_null(rel, c.column, c.where)
    if c.kind == "unique":
        return C.unique(rel, c.column, c.where)
    if c.kind == "accepted_values":
        return C.accepted_values(rel, c.column, c.args["values"], c.where)
    if c.kind == "relationships":
        return C.relationships(rel, c.column, models[c.args["to"]], c.args["field"], c.where)
    if c.kind == "unique_combination":
        return C.unique_combination(rel, c.args["columns"], c.where)
    if c.kind == "expression_is_true":
        return C.expression_is_true(rel, c.args["expression"], c.column, c.where)
    if c.kind == "positive_value":
        return C.positive_value(rel, c.column, c.args.get("allow_zero", False), c.where)
    if c.kind == "margin_reconciliation":
        return C.margin_reconciliation(rel, models[c.args["report"]], c.args["days"],
                                       c.args["tolerance"])
    raise ValueError(c.kind)


def _union_all(parts: list[DataFrame]) -> DataFrame:
    """Balanced union (a left-deep chain re-analyses the growing plan at every step)."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def _contributions(c: Check, i: int, rel: DataFrame, models) -> DataFrame:
    """Rows (check_id, n) whose sum is the failure count of a set-level check."""
    cid = F.lit(i).alias("check_id")
    if c.kind == "relationships":
        # per-key child counts meet the parent keys 
        per_key = (C._scope(rel, c.where).filter(F.col(c.column).isNotNull())
                   .groupBy(F.col(c.column).alias("_fk")).agg(F.count(F.lit(1)).alias("n")))
        keys = models[c.args["to"]].select(F.col(c.args["field"]).alias("_parent_key"))
        orphans = per_key.join(keys, per_key["_fk"] == keys["_parent_key"], "left_anti")
        return orphans.select(cid, F.col("n").cast("long").alias("n"))
    return check_failures(c, models).select(cid, F.lit(1).cast("long").alias("n"))


def _fused_uniqueness(rel: DataFrame, items: list[tuple[int, Check]]):
    """All unscoped unique / unique_combination checks of one relation as ONE
    grouping-sets aggregation (one shuffle instead of one per check).

    Returns (contributions DataFrame, covered check ids), or (None, []) when
    fewer than two checks qualify.  ``unique`` ignores NULL values; a column
    combination counts NULLs as values.
    """
    sets = [(i, [c.column], True) for i, c in items if c.kind == "unique" and not c.where]
    sets += [(i, list(c.args["columns"]), False) for i, c in items
             if c.kind == "unique_combination" and not c.where]
    if len(sets) < 2:
        return None, []
    cols: list[str] = []
    for _, s, _ in sets:
        cols += [c for c in s if c not in cols]
    distinct_sets = []
    for _, s, _ in sets:
        if s not in distinct_sets:
            distinct_sets.append(s)

    def gid(s):  # grouping_id(): bit set for every column not grouped in the set
        return sum(1 << (len(cols) - 1 - j) for j, c in enumerate(cols) if c not in s)

    groups = (rel.groupingSets(distinct_sets, *cols)
                 .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_gid"))
                 .filter(F.col("_n") > 1))
    ids = F.array(*[F.when((F.col("_gid") == gid(s))
                           & (F.col(s[0]).isNotNull() if drop_null else F.lit(True)), F.lit(i))
                    for i, s, drop_null in sets])
    out = (groups.select(F.explode(ids).alias("check_id"))
                 .filter(F.col("check_id").isNotNull())
                 .select("check_id", F.lit(1).cast("long").alias("n")))
    return out, [i for i, _, _ in sets]


def row_level_counts(catalogue: list[Check] = CATALOGUE):
    """The failure counts of all row-level checks of a relation, as aggregates
    named by check, to be taken in the pass that writes it (``sinks.observation``)."""
    def watch(relation: str):
        return [F.count(F.when(_fail_condition(c), F.lit(1))).alias(f"check_{i}")
                for i, c in enumerate(catalogue, start=1) if c.relation == relation and c.kind in ROW_LEVEL]
    return watch


def _by_relation(catalogue: list[Check], relations: set[str] | None = None) -> dict[str, list[tuple[int, Check]]]:
    by_rel: dict[str, list[tuple[int, Check]]] = {}
    for i, c in enumerate(catalogue, start=1):
        if relations is None or c.relation in relations:
            by_rel.setdefault(c.relation, []).append((i, c))
    return by_rel


def _relation_parts(rel: DataFrame, items: list[tuple[int, Check]], models,
                    observed: dict[str, int]) -> list[DataFrame]:
    """Rows (check_id, n) of a relation's checks whose counts are not known yet; the sum
    per check is its failure count."""
    items = [(i, c) for i, c in items if f"check_{i}" not in observed]
    parts: list[DataFrame] = []
    fused = [(i, c) for i, c in items if c.kind in ROW_LEVEL]
    if fused:
        aggs = []
        for i, c in fused:
            cond = _fail_condition(c)
            aggs.append(F.count(F.when(cond, F.lit(1))).alias(f"c{i}"))
        rows = F.array(*[F.struct(F.lit(i).alias("check_id"),
                                  F.col(f"c{i}").cast("long").alias("n"))
                         for i, _ in fused])
        parts.append(rel.agg(*aggs).select(F.inline(rows)))
    fused_sets, covered = _fused_uniqueness(rel, items)
    if fused_sets is not None:
        parts.append(fused_sets)
    parts.extend(_contributions(c, i, rel, models) for i, c in items
                 if c.kind not in ROW_LEVEL and i not in covered)
    return parts


def _summed(parts: list[DataFrame]) -> DataFrame:
    # One map-side-combined count per check over all contributions (a single
    # shuffle instead of one global aggregate per check).
    return _union_all(parts).groupBy("check_id").agg(F.sum("n").cast("long").alias("failures"))


def count_checks(models, catalogue: list[Check] = CATALOGUE,
                 observed: dict[str, int] | None = None) -> dict[str, int]:
    """The counts of the checks that are not in ``observed``, by name, taken one relation
    after the other: the driver holds the plans, tasks and file lists of one relation's
    checks at a time, and a row per failing check comes to it."""
    observed, taken = observed or {}, {}
    for rel_name, items in _by_relation(catalogue).items():
        parts = _relation_parts(models[rel_name], items, models, observed)
        found = dict(_summed(parts).collect()) if parts else {}
        taken |= {f"check_{i}": found.get(i, 0) for i, _ in items if f"check_{i}" not in observed}
    return taken


def run_checks(models, catalogue: list[Check] = CATALOGUE,
               relations: set[str] | None = None, observed: dict[str, int] | None = None) -> DataFrame:
    """One row per check.  ``observed``: counts of checks that were taken before (while
    the models were written, or by ``count_checks``); those checks read nothing."""
    observed = observed or {}
    spark = None
    parts: list[DataFrame] = []
    by_rel = _by_relation(catalogue, relations)
    for rel_name, items in by_rel.items():
        rel = models[rel_name]
        spark = rel.sparkSession
        parts.extend(_relation_parts(rel, items, models, observed))

    if observed:
        ids = [i for items in by_rel.values() for i, _ in items if f"check_{i}" in observed]
        parts.append(spark.createDataFrame([(i, observed[f"check_{i}"]) for i in ids], "check_id int, n bigint"))

    counts = _summed(parts)
    meta_schema = StructType([StructField("check_id", IntegerType()),
                              StructField("layer", StringType()),
                              StructField("relation", StringType()),
                              StructField("column_name", StringType()),
                              StructField("check_name", StringType()),
                              StructField("severity", StringType())])
    # The catalogue itself (one row per declared check — a fixed, small list).
    selected = [(i, c) for i, c in enumerate(catalogue, start=1)
                if relations is None or c.relation in relations]
    meta = spark.createDataFrame(
        [(i, LAYER_OF.get(c.relation, "gold"), c.relation, c.column, c.kind, c.severity)
         for i, c in selected], meta_schema)
    out = meta.join(counts, "check_id", "left").withColumn(
        "failures", F.coalesce(F.col("failures"), F.lit(0).cast("long")))
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
               .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    return out.select("check_id", "layer", "relation", "column_name", "check_name", "severity",
                      "failures", status.alias("status"))
