"""Event enrichment: lower-case addresses, contract label, transaction kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocktide import schemas as S
from blocktide.functions.labels import set_entry

#: Contracts of which the lookup is broadcast, at most.
BROADCAST_CONTRACTS = 200_000
#: Targets that are looked for as hot ones, and counters of the sketch that finds them:
#: any target of more than about a two-thousandth of all events is among them.
HOT_TARGETS = 1_000
HOT_COUNTERS = 10_000


def hot_targets(events: DataFrame) -> list[str]:
    """The most frequent target addresses, HOT_TARGETS at most, by a mergeable sketch.

    Each task keeps a bounded number of counters, so this is one pass over one column.
    """
    targets = events.filter(F.col("to_address") != "").select(F.lower("to_address").alias("to_address"))
    sketch = F.call_function(
        "approx_top_k", F.col("to_address"), F.lit(HOT_TARGETS), F.lit(HOT_COUNTERS)
    )
    found = targets.agg(sketch.alias("top")).select("top.item").first()
    return list(found["item"] or []) if found else []


def _with_contract_shuffled(lowered: DataFrame, lookup: DataFrame) -> DataFrame:
    """``lookup`` of any size joined by shuffle, with no hot key.

    Hot targets are few: their contracts are broadcast, and their events, like those
    without a target, take part in the shuffle under keys that match nothing. A stream
    cannot be counted ahead; there only events without a target are spread.
    """
    scattered = F.concat(F.lit("\x00"), F.coalesce("id", F.lit("")))
    has_target = F.col("to_address") != ""
    if lowered.isStreaming:
        target = F.when(has_target, F.col("to_address")).otherwise(scattered)
        return lowered.join(lookup, target == F.col("_contract"), "left")
    spark = lowered.sparkSession
    listed = spark.createDataFrame([(t,) for t in hot_targets(lowered)], "_target string")
    hot = listed.join(lookup, F.col("_target") == F.col("_contract"), "left").select(
        "_target", F.col("_contract").alias("_hot_contract"), F.col("_label").alias("_hot_label")
    )
    placed = lowered.join(F.broadcast(hot), F.col("to_address") == F.col("_target"), "left")
    target = F.when(has_target & F.col("_target").isNull(), F.col("to_address")).otherwise(scattered)
    joined = placed.withColumn("_key", target).join(lookup, F.col("_key") == F.col("_contract"), "left")
    return joined.withColumns(
        {
            "_contract": F.coalesce("_contract", "_hot_contract"),
            "_label": F.when(F.col("_target").isNull(), F.col("_label")).otherwise(F.col("_hot_label")),
        }
    ).drop("_target", "_hot_contract", "_hot_label", "_key")


def enrich(
    events: DataFrame, contracts: DataFrame | None = None, broadcast_rows: int | None = None
) -> DataFrame:
    """Normalized copy of ``events``.

    Without ``contracts`` the five fixed contracts are looked up in a literal
    map: no join, and the lookup is pruned away when a later step does not
    read ``attributes``. ``contracts(address, label)`` of any size is joined
    instead: by broadcast if its addresses were counted to be ``broadcast_rows``
    (BROADCAST_CONTRACTS) at most, else by shuffle, where neither a hot contract nor
    the events without a target are one key.
    """
    lowered = events.withColumns(
        {"from_address": F.lower("from_address"), "to_address": F.lower("to_address")}
    )
    if contracts is None:
        table = F.create_map(
            *[F.lit(text) for pair in S.KNOWN_CONTRACTS.items() for text in pair]
        )
        label = F.element_at(table, F.col("to_address"))
        return lowered.withColumn("attributes", _attributes(label, label.isNotNull()))

    lookup = contracts.groupBy(F.lower("address").alias("_contract")).agg(
        F.min("label").alias("_label")
    )
    most = BROADCAST_CONTRACTS if broadcast_rows is None else broadcast_rows
    if lookup.limit(most + 1).count() <= most:
        joined = lowered.join(F.broadcast(lookup), F.col("to_address") == F.col("_contract"), "left")
    else:
        joined = _with_contract_shuffled(lowered, lookup)
    label = F.nullif(F.col("_label"), F.lit(""))
    return joined.withColumn(
        "attributes", _attributes(label, F.col("_contract").isNotNull())
    ).drop("_contract", "_label")


def _attributes(label: Column, is_contract: Column) -> Column:
    is_tx = F.col("type") == S.TYPE_TRANSACTION
    has_target = F.coalesce(F.col("to_address"), F.lit("")) != ""
    kind = F.when(
        is_tx & has_target,
        F.when(is_contract, F.lit("contract_call")).otherwise(F.lit("transfer")),
    )
    empty = F.create_map().cast("map<string,string>")
    base = F.coalesce(F.col("attributes"), empty)
    return F.when(
        is_tx | label.isNotNull(),
        set_entry(set_entry(base, "contract_label", label), "tx_kind", kind),
    ).otherwise(F.col("attributes"))
