"""One row per order: milestone times and actors, promise, flags and durations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions.joins import null_safe_join
from parcelpulse.functions.sequences import HOT_KEY_ROWS, hot_keys
from parcelpulse.functions.times import hours_between, parse_time
from parcelpulse.session import staged
from parcelpulse.sources import schemas as S

ORDER_KEYS = ("logistic_order_id", "source_order_type", "fulfillment_order_type", "year_month")


@dataclass(frozen=True)
class Milestone:
    """``<name>_at`` is the first or last time at which ``column`` equals ``value``."""

    name: str
    column: str
    value: str
    pick: str = "first"
    actor: bool = True


MILESTONES = (
    Milestone("created", "event_type", S.CREATED),
    Milestone("packed", "event_type", S.PACKED),
    Milestone("dispatched", "event_type", S.DISPATCHED),
    Milestone("item_dispatched", "event_type", S.ITEM_DISPATCHED, actor=False),
    Milestone("completed", "order_state", S.COMPLETED, pick="last"),
    Milestone("cancelled", "event_type", S.ANNULLED_ITEMS, pick="last"),
)


TRAITS = ("event_type", "order_state", "executed_by")
#: Up to so many distinct actors, types and states (times of four digits of years) are aggregated as numbers.
MOST_NUMBERED = {"executed_by": 128, "event_type": 64, "order_state": 31}
MOST_KINDS = 4_096
#: Beyond any time of years 1 to 9999, in microseconds; 32 times that is still a long.
FAR_MICROS = 280_000_000_000_000_000


def milestones(
    events: DataFrame, spec: Sequence[Milestone] = MILESTONES, keys: Sequence[str] = ORDER_KEYS, limit: int = HOT_KEY_ROWS
) -> DataFrame:
    """Pivot the event log to one row per key.

    An actor is the largest name among the matching rows, and the last state the
    largest state, not the latest one; ``last_state_in_time`` is the latest.

    What is needed of the events is stored, as it is read twice: to see whether a key has more
    than ``limit`` events, and to combine them. Ordinary keys take one aggregation, which begins
    on the map side and shuffles a row per key and task. Where the traits have few distinct values, as types,
    states and groups of actors have, they go into it as numbers, in buffers of fixed width that are hashed and
    neither sorted nor spilled; for those keys that serves hot ones too. Otherwise hot keys go by way of their traits.
    """
    events = staged(events.select(*keys, "event_at", *TRAITS), "milestone-events", codec="zstd")
    names = _few_traits(events)
    if names is not None:
        return _milestones_by_number(events, names, spec, keys)
    hot = hot_keys(events, keys, limit)
    if hot is None:
        return _milestones_at_once(events, spec, keys)
    cold = _milestones_at_once(null_safe_join(events, hot, list(keys), "left_anti"), spec, keys)
    return cold.unionByName(_milestones_by_trait(null_safe_join(events, hot, list(keys), "left_semi"), spec, keys))


def _few_traits(events: DataFrame) -> dict[str, list[str]] | None:
    """The distinct values of each trait in order, or None if they are many or times lie too far off to be packed."""
    kinds = events.groupBy(*TRAITS).agg(F.min("event_at").alias("first"), F.max("event_at").alias("last"))
    far = [F.abs(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(c))) >= FAR_MICROS for c in ("first", "last")]
    some = kinds.select(*TRAITS, F.coalesce(far[0] | far[1], F.lit(False)).alias("far")).limit(MOST_KINDS + 1).collect()  # kinds of events, no rows
    if len(some) > MOST_KINDS or any(r.far for r in some):
        return None
    # by UTF-8 bytes, as Spark compares text
    names = {c: sorted({r[c] for r in some} - {None}, key=lambda v: v.encode()) for c in TRAITS}
    return names if all(len(v) <= MOST_NUMBERED[c] for c, v in names.items()) else None


def _milestones_by_number(
    events: DataFrame, names: dict[str, list[str]], spec: Sequence[Milestone], keys: Sequence[str]
) -> DataFrame:
    """One aggregation over numbers of fixed width; the number of a value is its place in order, from 1.

    A set of values is one bit for each, in words of 64.
    """
    known = {c: F.array(*[F.lit(v) for v in names[c]]).cast("array<string>") for c in TRAITS}
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("event_at"))
    numbered = events.select(
        *keys, "event_at", *TRAITS, *[F.array_position(known[c], F.col(c)).cast("int").alias(f"__{c}") for c in TRAITS]
    )
    out: list[Column] = []
    for m in spec:
        hit = F.col(m.column) == m.value
        at = F.when(hit, F.col("event_at"))
        out.append((F.min(at) if m.pick == "first" else F.max(at)).alias(f"{m.name}_at"))
        if m.actor:
            out.append(F.max(F.when(hit, F.col("__executed_by"))).alias(f"{m.name}_by"))
    sets = {}
    for c in ("executed_by", "event_type"):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col(f"__{c}") - 1, F.lit(64)).cast("int"))
        sets[c] = [
            F.bit_or(F.when((F.col(f"__{c}") > 64 * w) & (F.col(f"__{c}") <= 64 * w + 64), bit)).alias(f"__{c}_{w}")
            for w in range((len(names[c]) + 63) // 64)
        ]
    packed = F.coalesce(micros, F.lit(-FAR_MICROS)) * 32 + F.coalesce(F.col("__order_state"), F.lit(0))
    by_key = numbered.groupBy(*keys).agg(
        *out,
        F.max("event_at").alias("last_event_at"), F.max("__order_state").alias("last_state"),
        F.max(packed).alias("last_state_in_time"), F.count(F.lit(1)).alias("total_events"),
        *sets["executed_by"], *sets["event_type"],
    )

    def named(column: str, number: Column) -> Column:
        return F.get(known[column], number - 1)

    def size(column: str) -> Column:
        return sum((F.coalesce(F.bit_count(f"__{column}_{w}"), F.lit(0)) for w in range(len(sets[column]))), F.lit(0)).cast("long")

    actors = {f"{m.name}_by" for m in spec if m.actor}
    times = [c for m in spec for c in (f"{m.name}_at", f"{m.name}_by") if c.endswith("_at") or c in actors]
    return by_key.select(
        *keys,
        *[named("executed_by", F.col(c)).alias(c) if c in actors else F.col(c) for c in times],
        "last_event_at", named("order_state", F.col("last_state")).alias("last_state"),
        named("order_state", F.pmod(F.col("last_state_in_time"), F.lit(32)).cast("int")).alias("last_state_in_time"),
        "total_events", size("executed_by").alias("total_actors"), size("event_type").alias("total_event_types"),
    )


def _milestones_at_once(events: DataFrame, spec: Sequence[Milestone], keys: Sequence[str]) -> DataFrame:
    """One aggregation; a key's distinct types and actors, of bounded number here, stand in a set."""
    out: list[Column] = []
    for m in spec:
        hit = F.col(m.column) == m.value
        at = F.when(hit, F.col("event_at"))
        out.append((F.min(at) if m.pick == "first" else F.max(at)).alias(f"{m.name}_at"))
        if m.actor:
            out.append(F.max(F.when(hit, F.col("executed_by"))).alias(f"{m.name}_by"))

    def distinct(column: str) -> Column:
        return F.size(F.collect_set(column)).cast("long")

    return events.groupBy(*keys).agg(
        *out,
        F.max("event_at").alias("last_event_at"),
        F.max("order_state").alias("last_state"),
        F.max(F.struct("event_at", "order_state"))["order_state"].alias("last_state_in_time"),
        F.count(F.lit(1)).alias("total_events"),
        distinct("executed_by").alias("total_actors"),
        distinct("event_type").alias("total_event_types"),
    )


def _milestones_by_trait(events: DataFrame, spec: Sequence[Milestone], keys: Sequence[str]) -> DataFrame:
    """The same for keys with very many events.

    An event stands once for each of its traits, and is combined per (key, trait, value) with
    buffers of fixed width, which hash-aggregates on the map side and spreads a key with very
    many events. That leaves one row per distinct type, state and actor of a key, from which a
    second aggregation takes milestones and distinct counts. A bit per milestone says which ones
    an actor had a hand in.
    """
    acted = [m for m in spec if m.actor]
    hands = F.lit(0)
    for i, m in enumerate(acted):
        hands = hands + F.when(F.col(m.column) == m.value, 1 << i).otherwise(0)
    sides = F.explode(F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("value")) for i, c in enumerate(TRAITS)]))
    part = (
        events.select(*keys, "event_at", hands.alias("hands"), sides.alias("trait"))
        .groupBy(*keys, F.col("trait.side").alias("side"), F.col("trait.value").alias("value"))
        .agg(
            F.min("event_at").alias("first_at"), F.max("event_at").alias("last_at"),
            F.bit_or("hands").alias("hands"), F.count(F.lit(1)).alias("n"),
        )
    )
    value, known = F.col("value"), F.col("value").isNotNull()
    of = {c: F.col("side") == i for i, c in enumerate(TRAITS)}
    out: list[Column] = []
    for m in spec:
        hit = of[m.column] & (value == m.value)
        at = F.min(F.when(hit, F.col("first_at"))) if m.pick == "first" else F.max(F.when(hit, F.col("last_at")))
        out.append(at.alias(f"{m.name}_at"))
        if m.actor:
            bit = F.col("hands").bitwiseAND(1 << acted.index(m)) != 0
            out.append(F.max(F.when(of["executed_by"] & bit, value)).alias(f"{m.name}_by"))
    return part.groupBy(*keys).agg(
        *out,
        F.max("last_at").alias("last_event_at"),
        F.max(F.when(of["order_state"], value)).alias("last_state"),
        F.max_by("value", F.when(of["order_state"], F.struct("last_at", "value"))).alias("last_state_in_time"),
        F.sum(F.when(of["event_type"], F.col("n"))).alias("total_events"),
        F.count_if(of["executed_by"] & known).alias("total_actors"),
        F.count_if(of["event_type"] & known).alias("total_event_types"),
    )


def promise_per_order(packages: DataFrame) -> DataFrame:
    """Earliest promise of each order, from its dispatched packages."""
    return (
        packages.where(F.col("event_type") == S.DISPATCHED)
        .groupBy("logistic_order_id")
        .agg(
            F.min(parse_time(F.col("promised_date_to"))).alias("promised_date_to"),
            F.min(parse_time(F.col("promised_date_from"))).alias("promised_date_from"),
            F.max("service_category").alias("service_category"),
            F.bool_or("is_click_and_collect").alias("is_click_and_collect"),
        )
    )


def order_timeline(
    events: DataFrame, packages: DataFrame, high_season: Sequence[str], keys: Sequence[str] = ORDER_KEYS
) -> DataFrame:
    """Milestones with promise, state flags, leg durations and SLA verdict.

    With the default keys an order that spans two months has two rows. With
    ``keys=("logistic_order_id",)`` it has one, in the month of its creation.
    """
    base = milestones(events, keys=keys)
    if "year_month" not in keys:
        base = base.withColumn("year_month", F.date_format("created_at", "yyyy-MM"))
    joined = base.join(promise_per_order(packages), "logistic_order_id", "left")
    at = {m.name: F.col(f"{m.name}_at") for m in MILESTONES}
    promise = F.col("promised_date_to")
    stages = [
        ("hours_created_to_packed", "created", "packed"),
        ("hours_packed_to_dispatched", "packed", "dispatched"),
        ("hours_dispatched_to_completed", "dispatched", "completed"),
        ("hours_total_cycle", "created", "completed"),
    ]
    derived = {f"is_{n}": at[n].isNotNull() for n in ("completed", "cancelled", "dispatched", "packed")}
    derived["is_stuck"] = (
        at["created"].isNotNull() & at["dispatched"].isNull() & at["cancelled"].isNull() & at["completed"].isNull()
    )
    derived |= {name: hours_between(at[a], at[b]) for name, a, b in stages}
    # NULL when the order is not completed or nothing was promised; on time at equality
    derived["is_sla_breach"] = at["completed"] > promise
    derived["hours_sla_delta"] = hours_between(promise, at["completed"])
    derived["is_high_season"] = F.coalesce(F.col("year_month").isin(list(high_season)), F.lit(False))
    counts = ["total_events", "total_actors", "total_event_types"]
    return joined.select(
        *[c for c in joined.columns if c not in counts], *[c.alias(n) for n, c in derived.items()], *counts
    )
