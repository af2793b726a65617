"""Type-2 history from extracts that arrive in any order.

What is stored are observations: per key the spans of runs over which its whole
row was the same, plus the runs that had been applied.  That is all the extracts
hold, without repetition, so an extract that arrives late can be spliced in: the
observation that covers its time ends there, the late row holds until the next
run that knows the key, and what was seen there goes on.  The type-2 history (a new
version only where a checked column changes, other columns as they were when the
version opened) is derived from the observations, so it is the history of the right
order whatever the order of arrival.

Keys that a run can't apply (``set_aside``) are noted as unclear for that run: as
in a run of the right order, whatever was known before holds through it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finmart.functions.keys import scd_version_id
from finmart.operators.scd2 import SCD_COLUMNS, usable_rows

FROM, TO = "seen_from", "seen_to"


def _ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def splice(observations: DataFrame | None, unclear: DataFrame | None, runs: list[str],
           extract: DataFrame, key: str, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(observations, unclear) with an extract more.  ``observations``: the data
    columns, ``seen_from`` and ``seen_to`` (null: still so); ``unclear``: key and
    run; ``runs``: times of the extracts in it, any order; ``as_of`` is none of them."""
    if any(_same_time(r, as_of) for r in runs):
        raise ValueError(f"a run as of {as_of} is in the history already")
    spark, data = extract.sparkSession, extract.columns
    types = {f.name: f.dataType for f in extract.schema.fields}
    good, bad = usable_rows(extract, key)
    noted = bad.select(F.col("_k").alias("key"), _ts(as_of).alias("run"))
    if observations is None:
        observations = spark.createDataFrame([], extract.schema).withColumns(
            {FROM: _ts(as_of), TO: F.lit(None).cast("timestamp_ntz")})
        unclear = noted.limit(0)

    # the next run that knows the key: the first later one at which it was clear
    later = F.array_sort(F.array(*[_ts(r) for r in runs]) if runs else F.array().cast("array<timestamp_ntz>"))
    later = F.filter(later, lambda r: r > _ts(as_of))
    skipped = unclear.groupBy(F.col("key").alias("_k")).agg(F.collect_set("run").alias("_skipped"))

    covers = (F.col(FROM) <= _ts(as_of)) & (F.col(TO).isNull() | (F.col(TO) > _ts(as_of)))
    here = observations.filter(covers).select(F.col(key).alias("_k"), F.struct(*data, FROM, TO).alias("o"))
    rest = observations.filter(~covers).select(*data, FROM, TO)
    held = here.join(bad, "_k", "left_semi").select("o.*")  # unclear: it goes on
    here = here.join(bad, "_k", "left_anti")
    both = (good.join(here, "_k", "left").select("_k", "c", "o")
            .unionByName(here.join(good, "_k", "left_anti").withColumn("c", F.lit(None).cast(good.schema["c"].dataType))))
    known = F.coalesce("_skipped", F.array().cast("array<timestamp_ntz>"))
    both = both.join(skipped, "_k", "left").withColumn(
        "_next", F.get(F.filter(later, lambda r: ~F.array_contains(known, r)), F.lit(0)))

    o, c, after = F.col("o"), F.col("c"), F.col("_next")
    same = F.lit(True)
    for d in data:
        same = same & c[d].eqNullSafe(o[d].cast(types[d]))

    def row(side: Column, start: Column, end: Column) -> Column:
        return F.struct(*[side[d].cast(types[d]).alias(d) for d in data],
                        start.cast("timestamp_ntz").alias(FROM), end.cast("timestamp_ntz").alias(TO))

    unchanged = o.isNotNull() & c.isNotNull() & same
    pieces = F.array(
        F.when(unchanged, row(o, o[FROM], o[TO])),
        F.when(~unchanged & o.isNotNull(), row(o, o[FROM], _ts(as_of))),
        F.when(~unchanged & c.isNotNull(), row(c, _ts(as_of), after)),
        # what the next run saw: it goes on from there, unless it ended there anyway
        F.when(~unchanged & o.isNotNull() & after.isNotNull() & (o[TO].isNull() | (o[TO] > after)),
               row(o, after, o[TO])))
    spliced = both.select(F.inline(F.filter(pieces, lambda p: p.isNotNull())))
    out = rest.unionByName(held.select(*data, FROM, TO)).unionByName(spliced.select(*data, FROM, TO))
    return joined_spans(out, key, data), unclear.unionByName(noted)


def _same_time(a: str, b: str) -> bool:
    import datetime as dt
    return dt.datetime.fromisoformat(a) == dt.datetime.fromisoformat(b)


def joined_spans(rows: DataFrame, key: str, same: list[str], keep_first: list[str] | None = None) -> DataFrame:
    """Spans of a key that follow each other without a gap and are equal in
    ``same`` become one, with the first one's other columns."""
    columns = rows.columns
    in_time = Window.partitionBy(key).orderBy(FROM)
    equal = F.lag(TO).over(in_time).eqNullSafe(F.col(FROM))
    for c in same:
        equal = equal & F.lag(c).over(in_time).eqNullSafe(F.col(c))
    begun = rows.withColumn("_new", F.when(F.coalesce(equal, F.lit(False)), 0).otherwise(1)).withColumn(
        "_part", F.sum("_new").over(in_time))
    first = F.min(F.struct(FROM, *[c for c in columns if c not in (FROM, TO)])).alias("f")
    # an open span is the last one of its key
    end = F.when(F.count(F.lit(1)) == F.count(TO), F.max(TO)).alias(TO)
    spans = begun.groupBy(F.col(key).alias("_k"), "_part").agg(first, end)
    return spans.select(*[F.col(TO) if c == TO else F.col(f"f.{c}").alias(c) for c in columns])


def history(observations: DataFrame, key: str, check_cols: list[str]) -> DataFrame:
    """The type-2 snapshot that runs in the right order would have made."""
    data = [c for c in observations.columns if c not in (FROM, TO)]
    spans = joined_spans(observations, key, check_cols)
    opened = F.date_format(F.col(FROM), "yyyy-MM-dd HH:mm:ss")
    values = (scd_version_id(F.col(key), opened), F.col(FROM), F.col(FROM), F.col(TO))
    return spans.select(*data, *[v.alias(n) for v, n in zip(values, SCD_COLUMNS)])
