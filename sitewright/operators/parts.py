"""Building blocks that keep big groups off single tasks."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.sources.files import measured


def merge_parts(keys: list[str], *parts: DataFrame) -> DataFrame:
    """One row per key out of parts that each hold some of its columns.

    A part has at most one row per key. Grouping treats null keys as equal, so
    this is a null-safe outer join; without keys the parts are one-row tables.
    """
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    values = [F.max(name).alias(name) for name in stacked.columns if name not in keys]
    return stacked.groupBy(*keys).agg(*values)


def distinct_counts(df: DataFrame, keys: list[str], counts: dict[str, str]) -> DataFrame:
    """Distinct non-null values per key: {result column: counted column}.

    The rows are reduced to their distinct combinations first. That step
    combines before it shuffles and spreads a large key over all its values;
    only its small result is expanded once per counted column.
    """
    wanted = list(dict.fromkeys([*keys, *counts.values()]))
    combos = df.select(*wanted).distinct()
    return combos.groupBy(*keys).agg(
        *[F.count_distinct(F.col(column)).alias(name) for name, column in counts.items()]
    )


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The row of each key that sorts first.

    A minimum over structs, not a row number: it combines before the shuffle,
    so a key with a large share of the rows is never sorted in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *rest)
    picked = df.groupBy(*keys).agg(F.min(ranked).alias("_first"))
    return picked.select(
        *[F.col(c) if c in keys else F.col("_first").getField(c).alias(c) for c in df.columns]
    )


# Rows of one key that a shuffle's task takes; a key with more is dealt over several.
SLOT_ROWS = 100_000
# What has this size when written may be broadcast.
BROADCAST_BYTES = 16 << 20


def key_plan(
    df: DataFrame, key: str, slot_rows: int = SLOT_ROWS, most_bytes: int = BROADCAST_BYTES
) -> DataFrame | None:
    """_hot and _slots: how many slots each key needs that has more than `slot_rows` rows; None if no key has.

    Every key is counted, and combined before the shuffle. The table is written
    and measured; a slot takes twice the rows as long as it is over `most_bytes`.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    hot, size = measured(counts.where(F.col("_n") > slot_rows), "key-plan")
    while size > most_bytes and not hot.isEmpty():
        slot_rows *= 2
        hot, size = measured(hot.where(F.col("_n") > slot_rows), "key-plan")
    slots = F.ceil(F.col("_n") / slot_rows).cast("long").alias("_slots")
    return None if hot.isEmpty() else hot.select("_hot", slots)


def planned_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    slot_rows: int = SLOT_ROWS,
    most_bytes: int = BROADCAST_BYTES,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Left equi-join on `key` in which no key can fill a task, whatever the number of such keys.

    `right` must be unique on `key`, and `left` a table, as it is read for its
    keys and its rows. The keys are counted first. Rows of a key with many are
    dealt over as many slots as their number asks for, and its right row is
    copied into each. Rows without a key meet nothing, so they are not
    shuffled. `keys_from` is a cheaper table than `left` to count its keys in.
    """
    plan = key_plan(left if keys_from is None else keys_from, key, slot_rows, most_bytes)
    present, absent = left.where(F.col(key).isNotNull()), left.where(F.col(key).isNull())
    if plan is None:
        joined = present.join(right, key, "left")
    else:
        hot, is_hot = F.broadcast(plan), F.col(key) == F.col("_hot")
        # A row's number, and not its content, so that equal rows are dealt too.
        dealt = F.pmod(F.monotonically_increasing_id(), F.coalesce("_slots", F.lit(1)))
        all_slots = F.sequence(F.lit(0).cast("long"), F.coalesce("_slots", F.lit(1)) - 1)
        slotted = present.join(hot, is_hot, "left").select(*left.columns, dealt.alias("_slot"))
        copied = right.join(hot, is_hot, "left").select(*right.columns, F.explode(all_slots).alias("_slot"))
        joined = slotted.join(copied, [key, "_slot"], "left").drop("_slot")
    return joined.unionByName(absent, allowMissingColumns=True)


def few_left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left equi-join on `key` for a `left` of few rows and a `right` of any size.

    `right` must be unique on `key`. It is only scanned: the left keys are
    broadcast to it, and what it has for them, no more rows than that, back.
    """
    wanted = F.broadcast(left.select(key).distinct())
    return left.join(F.broadcast(right.join(wanted, key, "left_semi")), key, "left")
