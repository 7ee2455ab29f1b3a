"""Many updates per profile, of mixed operations, applied in ``seq`` order.

Replaying a profile's updates one by one would put all of them into one task,
and one busy profile can hold a large part of an update feed. Every operation
here has a closed form instead, so the feed is reduced by ordinary
aggregations, which combine on the map side, and one lookup:

* a delete, and per property a set or unset, *cut off* everything before it;
* after the cut-off the first operation that gives an absent property a value
  decides whether it is a number, a list or something else;
* numeric adds after it commute: their sum is enough;
* a list element lives if it came after the last removal of that element; an
  element brought by a union counts once, and only if it is not there yet.

Operations that do not fit the kind of value they meet leave it unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import properties as P
from ..session import cut_lineage
from . import updates as U
from .joins import HOT_ROWS, lookup_join, shares_of

_NONE = ""  # never a JSON text, so it can stand for "no element"
_START = -(2**63)


def update_actions(updates: DataFrame) -> DataFrame:
    """``distinct_id, seq, op, payload`` rows to one row per property or list element.

    Result: ``distinct_id, prop, elem, seq, pos, op, value``. ``elem`` is the
    empty text unless the operation is about a list element; ``prop`` is NULL
    for a delete, and for an empty payload, which still makes a profile.
    """
    nothing = F.array(
        F.struct(F.lit(None).cast("string").alias("key"), F.lit("null").alias("value"))
    )
    entries = F.map_entries("payload")
    per_prop = (
        updates.where(F.col("distinct_id").isNotNull() & F.col("op").isin(*U.OPERATIONS))
        .withColumn(
            "e",
            F.explode_outer(
                F.when((F.col("op") == U.DELETE) | (F.size("payload") < 1), nothing).otherwise(
                    F.coalesce(entries, nothing)
                )
            ),
        )
        .select("distinct_id", "seq", "op", F.col("e.key").alias("prop"), F.col("e.value").alias("value"))
    )
    none = F.array(F.lit(_NONE))
    united = F.array_distinct(P.open_list("value"))
    elems = (
        F.when(F.col("prop").isNull(), none)
        .when(F.col("op").isin(U.APPEND, U.REMOVE), F.array("value"))
        # An empty union still makes an absent property a list.
        .when((F.col("op") == U.UNION) & (F.col("value") != "[]"), united)
        .otherwise(none)
    )
    # Outer explodes, for the reason given at ``explode_props``.
    rows = per_prop.select(
        "distinct_id", "prop", "seq", "op", "value", F.posexplode_outer(elems).alias("pos", "elem")
    )
    return rows.where(F.col("pos").isNotNull())


def _max_seq(*ops: str) -> Column:
    return F.max(F.when(F.col("op").isin(*ops), F.col("seq")))


def fold_updates(updates: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Reduce an update feed to one row per profile.

    Result: ``distinct_id``, ``wiped`` (a delete cut the stored profile off),
    ``creates`` (something after the delete makes a profile) and ``changes``,
    one entry per touched property. Its size is that of the profile, not of
    the feed. ``seq`` must be unique per profile.
    """
    actions = update_actions(updates)

    # One pass over the feed: everything else is derived from this far smaller table.
    reset = F.col("op").isin(U.SET, U.UNSET)
    base = actions.groupBy("distinct_id", "prop", "elem").agg(
        F.count(F.lit(1)).alias("n"),
        _max_seq(U.DELETE).alias("deleted"),
        _max_seq(U.SET, U.UNSET).alias("reset"),
        F.max_by(
            F.when(F.col("op") == U.SET, F.col("value")), F.when(reset, F.col("seq"))
        ).alias("reset_value"),
        _max_seq(U.REMOVE).alias("removed"),
        _max_seq(*U.CREATING).alias("creating"),
        _max_seq(U.SET_ONCE, U.ADD, U.APPEND, U.UNION).alias("building"),
    )

    # Per profile: the last delete and whether anything rebuilds it afterwards.
    base = cut_lineage(base, "fold")
    profiles = base.groupBy("distinct_id").agg(
        F.coalesce(F.max("deleted"), F.lit(_START)).alias("deleted"),
        F.coalesce(F.max("creating"), F.lit(_START)).alias("creating"),
    )
    lives = profiles.select(
        "distinct_id",
        F.col("deleted"),
        (F.col("deleted") > F.lit(_START)).alias("wiped"),
        (F.col("creating") > F.col("deleted")).alias("creates"),
    )

    # Per property: the last set or unset that outlived the delete.
    props = (
        base.where(F.col("prop").isNotNull())
        .groupBy("distinct_id", "prop")
        .agg(
            F.max("reset").alias("reset"),
            F.max_by("reset_value", "reset").alias("reset_value"),
        )
        .join(lives.select("distinct_id", "deleted", "wiped"), "distinct_id")
        .select(
            "distinct_id",
            "prop",
            "wiped",
            F.coalesce(F.col("reset") > F.col("deleted"), F.lit(False)).alias("is_reset"),
            F.when(F.col("reset") > F.col("deleted"), F.col("reset_value")).alias("reset_value"),
            F.greatest(F.coalesce("reset", F.lit(_START)), F.col("deleted")).alias("cut"),
        )
    )

    # Per property and element: the point before which nothing counts.
    elements = (
        base.where(F.col("building").isNotNull() | F.col("removed").isNotNull())
        .select("distinct_id", "prop", "elem", "n", "removed", "building")
        .join(props.select("distinct_id", "prop", "cut"), ["distinct_id", "prop"])
    )
    cutoffs = elements.where(F.col("building").isNotNull()).select(
        "distinct_id",
        "prop",
        "elem",
        "cut",
        F.coalesce("removed", F.lit(_START)).alias("removed"),
        "n",
    )
    keys = ["distinct_id", "prop", "elem"]
    live = lookup_join(
        actions.where(F.col("op").isin(U.SET_ONCE, U.ADD, U.APPEND, U.UNION)),
        cutoffs.drop("n"),
        keys,
        hot=shares_of(cutoffs, keys, hot_rows),
    ).where(F.col("seq") > F.col("cut"))

    scalars = live.groupBy("distinct_id", "prop").agg(
        F.min_by(F.struct("op", "value", "seq"), "seq").alias("first"),
        F.sum(F.when(F.col("op") == U.ADD, F.col("value").try_cast("double"))).alias("added"),
    )

    # A union counts only ahead of every live append of the same element.
    copies = (
        live.where(F.col("op").isin(U.APPEND, U.UNION) & (F.col("elem") != _NONE))
        .where(F.col("seq") > F.col("removed"))
        .groupBy(*keys)
        .agg(
            F.collect_list(F.when(F.col("op") == U.APPEND, F.col("seq"))).alias("appends"),
            F.min(F.when(F.col("op") == U.UNION, F.struct("seq", "pos"))).alias("union"),
        )
    )
    appended = F.transform(
        "appends",
        lambda s: F.struct(
            s.alias("seq"), F.lit(0).alias("pos"), F.col("elem"), F.lit(False).alias("by_union")
        ),
    )
    united = F.array(
        F.struct(
            F.col("union.seq").alias("seq"),
            F.col("union.pos").alias("pos"),
            F.col("elem"),
            F.lit(True).alias("by_union"),
        )
    )
    first_append = F.array_min("appends")
    counts = F.col("union").isNotNull() & (
        first_append.isNull() | (F.col("union.seq") < first_append)
    )
    brought = (
        copies.select(
            "distinct_id",
            "prop",
            F.when(counts, F.concat(united, appended)).otherwise(appended).alias("items"),
        )
        .groupBy("distinct_id", "prop")
        .agg(F.array_sort(F.flatten(F.collect_list("items"))).alias("brought"))
    )
    removals = (
        elements.where(F.col("removed") > F.col("cut"))
        .groupBy("distinct_id", "prop")
        .agg(F.collect_list(F.struct("elem", F.col("removed").alias("seq"))).alias("removals"))
    )

    on = ["distinct_id", "prop"]
    changes = (
        props.join(scalars, on, "left")
        .join(brought, on, "left")
        .join(removals, on, "left")
        .groupBy("distinct_id")
        .agg(
            F.collect_list(
                F.struct(
                    "prop", "wiped", "is_reset", "reset_value", "first", "added", "brought", "removals"
                )
            ).alias("changes")
        )
    )
    return lives.select("distinct_id", "wiped", "creates").join(changes, "distinct_id", "left")


def _new_value(c: Column, stored: Column) -> Column:
    """The value of one property after its folded change; NULL when it ends up absent."""
    base = F.when(c["is_reset"], c["reset_value"]).when(~c["wiped"], stored)

    def from_base(b: Column) -> Column:
        late = b.isNull() & (c["first"]["op"] == U.SET_ONCE)
        start = F.when(late, c["first"]["value"]).otherwise(b)
        # Removals before a set-once that took effect met an absent property.
        since = F.when(late, c["first"]["seq"]).otherwise(F.lit(_START))
        return P.bind(F.struct(start.alias("start"), since.alias("since")), from_start)

    def from_start(s: Column) -> Column:
        start, opener = s["start"], c["first"]["op"]
        is_number = start.rlike(r"^-?[0-9]") | (start.isNull() & (opener == U.ADD))
        is_list = P.is_list(start) | (start.isNull() & opener.isin(U.APPEND, U.UNION))
        changed = c["brought"].isNotNull() | c["removals"].isNotNull()
        return (
            F.when(is_number & c["added"].isNotNull(), _sum(start, c["added"]))
            .when(is_list & (changed | start.isNull()), _list(s, c))
            .otherwise(start)
        )

    return P.bind(base, from_base)


def _sum(start: Column, added: Column) -> Column:
    total = F.coalesce(start.try_cast("double"), F.lit(0.0)) + added
    return P.bind(total, lambda t: P.json_text(t, "double"))


def _list(s: Column, c: Column) -> Column:
    """List elements after removals, then what appends and unions brought."""
    held = F.coalesce(P.open_list(s["start"]), F.array().cast("array<string>"))
    gone = F.transform(
        F.filter(F.coalesce(c["removals"], F.array()), lambda r: r["seq"] > s["since"]),
        lambda r: r["elem"],
    )

    def without(held: Column) -> Column:
        # Set operations first, so that long lists are not compared pairwise.
        return P.bind(
            F.array_intersect(gone, held),
            lambda hit: F.filter(held, lambda e: ~F.array_contains(hit, e)),
        )

    def extended(left: Column) -> Column:
        brought = F.coalesce(c["brought"], F.array())
        united = F.transform(F.filter(brought, lambda b: b["by_union"]), lambda b: b["elem"])
        fresh = P.bind(
            F.array_intersect(united, left),
            lambda there: F.transform(
                F.filter(brought, lambda b: ~(b["by_union"] & F.array_contains(there, b["elem"]))),
                lambda b: b["elem"],
            ),
        )
        return P.close_list(F.concat(left, fresh))

    return P.bind(P.bind(held, without), extended)


def folded_props(stored: Column, wiped: Column, changes: Column) -> Column:
    """A property map after the folded changes of :func:`fold_updates`."""
    entries = F.transform(
        F.coalesce(changes, F.array()),
        lambda c: F.struct(
            c["prop"].alias("key"),
            _new_value(c, F.try_element_at(stored, c["prop"])).alias("value"),
        ),
    )
    touched = F.transform(F.coalesce(changes, F.array()), lambda c: c["prop"])
    kept = F.when(wiped, P.empty_props()).otherwise(
        F.map_filter(stored, lambda k, _: ~F.array_contains(touched, k))
    )
    written = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    return F.when(changes.isNull(), kept).otherwise(F.map_concat(kept, written))


def apply_updates(
    profiles: DataFrame, updates: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Profiles after all updates; ``updates`` is ``distinct_id, seq, op, payload``.

    Ids without a profile get one if an update creates it.
    """
    folded = fold_updates(updates, hot_rows)
    joined = profiles.withColumn("_stored", F.lit(True)).join(folded, "distinct_id", "full")
    stored = F.coalesce(F.col("properties"), P.empty_props())
    wiped = F.coalesce("wiped", F.lit(False))
    exists = F.coalesce("creates", F.lit(False)) | (F.col("_stored").isNotNull() & ~wiped)
    after = folded_props(stored, wiped, F.col("changes"))
    return joined.where(exists).withColumn("properties", after).select(*profiles.columns)


def apply_folded(profiles: DataFrame, deltas: DataFrame) -> DataFrame:
    """Profiles after several folded batches, applied in the order of ``batch``.

    ``deltas`` is what :func:`fold_updates` gives for each batch, with its
    number: one row per profile and batch. A profile's rows are brought together,
    at most one per batch, and applied one after another to what is stored.
    """
    changes = deltas.schema["changes"].dataType
    lined_up = deltas.groupBy("distinct_id").agg(
        F.array_sort(F.collect_list(F.struct("batch", "wiped", "creates"))).alias("fates"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("changes").isNotNull(), F.struct("batch", "changes")))
        ).alias("changes"),
    )
    joined = profiles.withColumn("_stored", F.lit(True)).join(lined_up, "distinct_id", "full")
    start = F.struct(
        F.col("_stored").isNotNull().alias("exists"),
        F.coalesce(F.col("properties"), P.empty_props()).alias("properties"),
    )

    def step(held: Column, delta: Column) -> Column:
        exists = delta["creates"] | (held["exists"] & ~delta["wiped"])
        changed = F.try_element_at(F.col("changes"), delta["batch"]).cast(changes)
        after = folded_props(held["properties"], delta["wiped"], changed)
        return F.struct(
            exists.alias("exists"), F.when(exists, after).otherwise(P.empty_props()).alias("properties")
        )

    held = F.when(F.col("fates").isNull(), start).otherwise(F.aggregate("fates", start, step))
    # The outer column keeps the fold from being computed once per use.
    return (
        joined.withColumn("_held", F.explode(F.array(held)))
        .where("_held.exists")
        .withColumn("properties", F.col("_held.properties"))
        .select(*profiles.columns)
    )
