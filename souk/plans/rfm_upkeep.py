"""Customer scores kept up to date from new orders only.

One state row per customer holds what the scores are made of: counts, exact sums, the first purchase and the latest order. All
of these merge, so a batch of new orders is folded in whatever its dates are, and no earlier order is read again. The
state of customers without new orders is copied without a shuffle where Spark broadcasts the batch's customers.

Quartile limits come from stored counts. Each score's order of customers is cut at fixed rows into ``RANGES`` ranges, and the
number of customers in each is kept. A batch moves its own customers between ranges; the rows at the quartiles are then
looked up in the ranges that hold them.

Each batch writes a version of its own below the root, its counts last. A version without them does not count, so a batch
that failed can be repeated, and one that was done is not done twice. The version before the newest stays.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.dates import days_between
from souk.operators.ordering import after, asc, desc
from souk.operators.ranking import POSITION, ntile_starts, range_sorted, rows_at
from souk.operators.staging import scope, stage
from souk.plans.rfm import CUSTOMER
from souk.sources import lake

QUARTILES = 4
#: Ranges of customers with stored counts, for each score.
RANGES = 32
#: The ranges are cut anew when one holds so many times its share.
UNEVEN = 4
#: The order of customers behind each score. It does not move with the day the recency is counted from.
STATE_KEYS = {
    "r_score": [desc("last_day"), asc(CUSTOMER)],
    "f_score": [desc("frequency"), asc(CUSTOMER)],
    "m_score": [desc("monetary"), asc(CUSTOMER)],
}
#: What is read of an order.
ORDER_COLUMNS = (
    "order_id",
    "order_status",
    "order_purchase_timestamp",
    CUSTOMER,
    "customer_state",
    "customer_city",
    "total_payment_value",
    "total_items",
    "review_score",
    "delivery_days",
)
SUMS = ("frequency", "monetary", "score_sum", "score_rows", "delivery_sum", "delivery_rows", "item_sum", "item_rows")
#: Row of the counts table that only says up to when orders have come.
CLOCK = "clock"


@dataclass(frozen=True)
class Range:
    """Customers from one row on, up to the first of the next range."""

    score: str
    first: dict[str, Any]
    rows: int


def delivered_state(orders: DataFrame) -> DataFrame:
    """One state row per customer of the delivered orders; orders without a customer are left out."""
    at = "order_purchase_timestamp"
    score = F.col("review_score").cast("decimal(38,10)")
    own = orders.filter((F.col("order_status") == "delivered") & F.col(CUSTOMER).isNotNull())
    return own.groupBy(CUSTOMER).agg(
        F.count("order_id").alias("frequency"),
        F.sum("total_payment_value").alias("monetary"),
        F.sum(score).alias("score_sum"),
        F.count(score).alias("score_rows"),
        F.sum("delivery_days").alias("delivery_sum"),
        F.count("delivery_days").alias("delivery_rows"),
        F.sum("total_items").alias("item_sum"),
        F.count("total_items").alias("item_rows"),
        F.max(F.struct(at, "order_id", "customer_state", "customer_city")).alias("latest"),
        F.min(at).alias("first_purchase_date"),
    )


def merged_state(parts: DataFrame) -> DataFrame:
    """State rows of the same customers added up."""
    kinds = {f.name: f.dataType for f in parts.schema.fields}
    return parts.groupBy(CUSTOMER).agg(
        *(F.sum(c).cast(kinds[c]).alias(c) for c in SUMS),
        F.max("latest").alias("latest"),
        F.min("first_purchase_date").alias("first_purchase_date"),
    )


def _with_last_day(state: DataFrame) -> DataFrame:
    return state.withColumn("last_day", F.unix_date(F.to_date("latest.order_purchase_timestamp")))


def _version(root: str, batch: int, part: str) -> str:
    return f"{root.rstrip('/')}/v{batch}/{part}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """The batches whose versions are whole, in order."""
    context = spark.sparkContext
    pattern = context._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/v*/counts/_SUCCESS")
    found = pattern.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(f.getPath().getParent().getParent().getName()[1:]) for f in found or ())


def _read_counts(spark: SparkSession, root: str, batch: int) -> tuple[date | None, list[Range]]:
    """The day of the last purchase so far and the ranges, at most ``RANGES`` per score."""
    rows = spark.read.parquet(_version(root, batch, "counts")).orderBy("score", "place").collect()
    clock = next(r["latest"] for r in rows if r["score"] == CLOCK)
    ranges = []
    for r in rows:
        if r["score"] != CLOCK:
            first = {key.column: r[key.column] for key in STATE_KEYS[r["score"]]}
            ranges.append(Range(r["score"], first, r["rows"]))
    return clock, ranges


def _write_counts(state: DataFrame, root: str, batch: int, clock: date | None, ranges: list[Range]) -> None:
    kinds = {f.name: f.dataType.simpleString() for f in state.schema.fields}
    names = list(dict.fromkeys(k.column for keys in STATE_KEYS.values() for k in keys))
    spec = "score string, place int, rows long, latest date, " + ", ".join(f"{c} {kinds[c]}" for c in names)
    rows = [(CLOCK, 0, 0, clock, *(None for _ in names))]
    rows += [(r.score, i, r.rows, None, *(r.first.get(c) for c in names)) for i, r in enumerate(ranges)]
    spark = state.sparkSession
    spark.createDataFrame(rows, spec).coalesce(1).write.mode("overwrite").parquet(_version(root, batch, "counts"))


def cut(state: DataFrame) -> list[Range]:
    """Every score's order of customers cut into ``RANGES`` ranges of equal size."""
    found = []
    for score, keys in STATE_KEYS.items():
        ordered = range_sorted(state.select(*(k.column for k in keys)), keys)
        total = ordered.count()
        starts = [0, *ntile_starts(total, RANGES)] if total else []
        firsts = {r[POSITION]: r for r in rows_at(ordered, lambda n, starts=starts: starts)}
        for start, end in zip(starts, [*starts[1:], total], strict=False):
            found.append(Range(score, {k.column: firsts[start][k.column] for k in keys}, end - start))
    return found


def _json(value: Any) -> str:
    return format(value, "f") if isinstance(value, Decimal) else json.dumps(value)


def _place(score: str, ranges: list[Range], state: DataFrame) -> Column:
    """The number of the range that a row of ``state`` falls in. Rows in front of the first one belong to it.

    The limits are one constant array of structs that compare as the score sorts, NULL behind all values. A row is placed
    by halving: with 32 ranges, five comparisons.
    """
    kinds = {f.name: f.dataType.simpleString() for f in state.schema.fields}
    keys = STATE_KEYS[score]

    def limit(first: dict[str, Any]) -> str:
        fields = []
        for i, key in enumerate(keys):
            value = first[key.column]
            signed = -value if key.descending and value is not None else value
            fields += [f'"n{i}": {_json(value is None)}', f'"v{i}": {_json(signed)}']
        return "{" + ", ".join(fields) + "}"

    if len(ranges) < 2:
        return F.lit(0)
    own = []
    for i, key in enumerate(keys):
        value = F.col(key.column)
        own += [value.isNull().alias(f"n{i}"), (-value if key.descending else value).alias(f"v{i}")]
    kind = ", ".join(f"n{i}: boolean, v{i}: {kinds[key.column]}" for i, key in enumerate(keys))
    text = "[" + ", ".join(limit(r.first) for r in ranges[1:]) + "]"
    limits = F.from_json(F.lit(text), f"array<struct<{kind}>>")
    row = F.struct(*own)
    steps = F.array(*(F.lit(1 << i) for i in reversed(range((len(ranges) - 1).bit_length()))))

    def upward(place: Column, step: Column) -> Column:
        """The first ``place`` limits are not above the row; past the last limit the comparison is NULL."""
        return F.when(F.get(limits, place + step - 1) <= row, place + step).otherwise(place)

    return F.aggregate(steps, F.lit(0), upward)


def moved(ranges: list[Range], gone: DataFrame, come: DataFrame) -> list[Range]:
    """The ranges with the rows of ``gone`` taken out and those of ``come`` put in; both have the size of a batch."""
    by_score = {score: [r for r in ranges if r.score == score] for score in STATE_KEYS}
    places = F.array(*(F.struct(F.lit(s).alias("score"), _place(s, own, come).alias("place")) for s, own in by_score.items()))
    both = gone.withColumn("change", F.lit(-1)).unionByName(come.withColumn("change", F.lit(1)))
    change = both.select("change", F.explode(places).alias("at")).groupBy("at.score", "at.place").agg(F.sum("change").alias("n"))
    changes = {(r["score"], r["place"]): r["n"] for r in change.collect()}
    return [Range(s, r.first, r.rows + changes.get((s, i), 0)) for s, own in by_score.items() for i, r in enumerate(own)]


def _uneven(ranges: list[Range]) -> bool:
    if not ranges:
        return True
    for score in STATE_KEYS:
        sizes = [r.rows for r in ranges if r.score == score]
        if max(sizes) > max(UNEVEN * sum(sizes) / RANGES, UNEVEN):
            return True
    return False


def last_day(orders: DataFrame) -> date | None:
    """The day of the last delivered order, from which recency is counted."""
    delivered = orders.filter(F.col("order_status") == "delivered")
    return delivered.agg(F.max(F.to_date("order_purchase_timestamp"))).first()[0]


def _advance(
    spark: SparkSession, root: str, batch: int, come: DataFrame, clock: date | None, asked: DataFrame | None = None
) -> None:
    """Write the version of ``batch``. ``come`` is added to the state or, for customers in ``asked``, takes its place."""
    done = versions(spark, root)
    old = max(done, default=None)
    come = stage(come)
    if old is None:
        state, ranges = _with_last_day(come), []
    else:
        past = spark.read.parquet(_version(root, old, "customers"))
        before, ranges = _read_counts(spark, root, old)
        ids = stage(asked.select(CUSTOMER).distinct()) if asked is not None else come.select(CUSTOMER)
        gone = stage(past.join(ids, CUSTOMER, "left_semi"))
        if asked is None:
            clock = max((c for c in (before, clock) if c is not None), default=None)
            come = stage(merged_state(gone.unionByName(come)))
        if ranges:
            ranges = moved(ranges, _with_last_day(gone), _with_last_day(come))
        state = _with_last_day(past.join(ids, CUSTOMER, "left_anti").unionByName(come))
    state.drop("last_day").write.mode("overwrite").parquet(_version(root, batch, "customers"))
    state = _with_last_day(spark.read.parquet(_version(root, batch, "customers")))
    _write_counts(state, root, batch, clock, cut(state) if _uneven(ranges) else ranges)
    lake.delete(spark, (f"{root.rstrip('/')}/v{v}" for v in done[:-1]))


def _is_done(spark: SparkSession, root: str, batch: int) -> bool:
    newest = max(versions(spark, root), default=None)
    if newest is not None and batch < newest:
        raise ValueError(f"batch {batch} comes after batch {newest} was done")
    return batch == newest


def fold(spark: SparkSession, root: str, orders: DataFrame, batch: int) -> None:
    """Add new orders, one row per order as in the silver table, to the state below ``root``.

    ``batch`` is a number that grows from call to call; a batch that is done already changes nothing, an older one is
    an error. Each order must come in one batch only and only once it is delivered for good; for customers whose
    orders changed, see ``rebuild``. An empty batch writes a version equal to the one before.
    """
    if _is_done(spark, root, batch):
        return
    with scope(spark):
        _advance(spark, root, batch, delivered_state(orders), last_day(orders))


def rebuild(spark: SparkSession, root: str, orders: DataFrame, customers: DataFrame, batch: int) -> None:
    """Make the state of some ``customers`` anew from all ``orders``, after orders of theirs were changed or withdrawn.

    A customer who has no delivered order left leaves the state. The last purchase is taken from all orders.
    """
    if _is_done(spark, root, batch):
        return
    with scope(spark):
        asked = stage(customers.select(CUSTOMER).filter(F.col(CUSTOMER).isNotNull()).distinct())
        own = orders.join(asked, CUSTOMER, "left_semi")
        _advance(spark, root, batch, delivered_state(own), last_day(orders), asked)


def _quartile_rows(state: DataFrame, score: str, ranges: list[Range]) -> Iterable[dict[str, Any]]:
    """The first row of each quartile but the best, looked up in the ranges that hold them."""
    keys = STATE_KEYS[score]
    own = [r for r in ranges if r.score == score]
    upto = [0]
    for r in own:
        upto.append(upto[-1] + r.rows)
    targets = ntile_starts(upto[-1], QUARTILES)
    wanted = sorted({next(i for i in range(len(own)) if upto[i] <= t < upto[i + 1]) for t in targets})
    if not wanted:
        return []
    inside, skipped, offsets = [], 0, []
    for i in wanted:
        starts = after(keys, own[i].first, inclusive=True) if i else F.lit(True)
        ends = after(keys, own[i + 1].first, inclusive=True) if i + 1 < len(own) else F.lit(False)
        inside.append(starts & ~ends)
        offsets += [skipped + t - upto[i] for t in targets if upto[i] <= t < upto[i + 1]]
        skipped += own[i].rows
    held = state.filter(reduce(lambda a, b: a | b, inside)).select(*(k.column for k in keys))
    return [r.asDict() for r in rows_at(range_sorted(held, keys), lambda n: offsets)]


def scored(spark: SparkSession, root: str) -> DataFrame:
    """``rfm.rfm_scores`` of all orders folded so far, from the newest version.

    Reads the state only; of it, the rows of a few ranges are sorted.
    """
    newest = max(versions(spark, root))
    state = _with_last_day(spark.read.parquet(_version(root, newest, "customers")))
    clock, ranges = _read_counts(spark, root, newest)
    scores = {}
    for score, keys in STATE_KEYS.items():
        limits = _quartile_rows(state, score, ranges)
        scores[score] = sum((after(keys, row, inclusive=True).cast("int") for row in limits), F.lit(1))

    def ratio(total: str, rows: str) -> Column:
        return F.try_divide(F.col(total).cast("double"), F.col(rows).cast("double"))

    last = F.col("latest.order_purchase_timestamp")
    return state.withColumns(scores).select(
        CUSTOMER,
        days_between(last, F.lit(clock).cast("date")).alias("recency"),
        "frequency",
        "monetary",
        ratio("score_sum", "score_rows").alias("avg_review_score"),
        ratio("delivery_sum", "delivery_rows").alias("avg_delivery_days"),
        ratio("item_sum", "item_rows").alias("avg_items_per_order"),
        F.col("latest.customer_state").alias("customer_state"),
        F.col("latest.customer_city").alias("customer_city"),
        last.alias("last_purchase_date"),
        "first_purchase_date",
        days_between(F.col("first_purchase_date"), last).alias("customer_tenure_days"),
        *scores,
        sum((F.col(s) for s in scores), F.lit(0)).alias("rfm_score"),
    )
