"""Alias tables as rows (N4): weighted draws by one equi-join.

A group of n choices has n slots of equal size. A slot belongs to one choice up
to its cut and to an alias above it, so that a draw is a slot and a place in
it: one row, found by an equi-join on (group, slot), however many choices the
group has and however they are weighted.

The table comes out of prefix sums, without a loop over the choices. Weights are
integers t (total W); a choice is light if n * t <= W. Light choices leave gaps
of W - n * t, heavy ones have n * t - W to give. Laid end to end in the order of
the choices, both fill the same line, and the gap that starts inside a heavy
choice's piece is filled by it. A heavy choice whose piece ends before its last
gap does lacks the rest in its own slot, which the next heavy one fills. All
numbers are exact integers.

Groups of any size work: the running sums and the merges of both lines go over
many tasks for a hot group (``operators/sequence.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.operators.sequence import HOT_KEY_ROWS, join_per_key, positions, running, with_next
from recsmith.session import cut_lineage

#: Steps of the largest weight of a group when weights are made integers.
TICKS = 1_000_000_000
_BIG = "decimal(38,0)"


def weight_ticks(adj: DataFrame, group: str, weight: str, out: str = "ticks", threshold: int = HOT_KEY_ROWS) -> DataFrame:
    """Integer weights: the group's largest is TICKS steps, none of the others
    less than one. Rows without a weight above 0 are left out."""
    rows = adj.where((F.col(weight) > 0) & ~F.isnan(F.col(weight).cast("double")))
    most = rows.groupBy(group).agg(F.max(weight).alias("_most"))
    share = F.round(F.col(weight).cast("double") / F.col("_most").cast("double") * F.lit(float(TICKS)))
    return join_per_key(rows, most, group, "inner", threshold).withColumn(
        out, F.greatest(F.lit(1).cast("bigint"), share.cast("bigint"))).drop("_most")


def alias_table(adj: DataFrame, group: str, choice: str, ticks: str, threshold: int = HOT_KEY_ROWS) -> DataFrame:
    """One row for each choice of a group with integer weights above 0:
    (group, slot, choice, cut, alias, size, n). A place below ``cut`` in a slot
    of ``size`` is the choice, any other the alias; there are ``n`` slots.
    Choices are distinct in their group; null is a group like any other."""
    rows = adj.select(group, choice, F.col(ticks).cast("bigint").alias("_t")).where(F.col("_t") > 0)
    totals = rows.groupBy(group).agg(F.sum("_t").alias("size"), F.count(F.lit(1)).alias("n"))
    placed = positions(rows, group, [choice], loc="slot", size=None, threshold=threshold)
    full = (F.col("n") * F.col("_t").cast("decimal(18,0)")).cast(_BIG)
    known = join_per_key(placed, totals, group, "inner", threshold).withColumn("slot", F.col("slot").cast("bigint"))
    known = (known.withColumn("_heavy", full > F.col("size")).withColumn("_gap", F.abs(full - F.col("size")).cast(_BIG))
             .withColumn("_side", F.struct(group, "_heavy")))
    # both lines: where each gap and each piece ends
    known = cut_lineage(running(known, "_side", [choice], sums={"_gap": "_end"}, threshold=threshold)
                        .withColumn("_end", F.col("_end").cast(_BIG)))
    even = known.where(F.col("_gap") == 0)
    light = known.where(~F.col("_heavy") & (F.col("_gap") > 0))
    heavy = known.where("_heavy")
    nothing = F.lit(None)
    # the heavy choice whose piece a gap starts in: the last one that starts at or before it
    line = [group, choice, "slot", "size", "n", "_gap", "_end"]
    merged = (heavy.select(*line, (F.col("_end") - F.col("_gap")).cast(_BIG).alias("_at"), F.lit(0).alias("_kind"), F.col(choice).alias("_giver"))
              .unionByName(light.select(*line, (F.col("_end") - F.col("_gap")).cast(_BIG).alias("_at"), F.lit(1).alias("_kind"),
                                        nothing.cast(adj.schema[choice].dataType).alias("_giver"))))
    filled = running(merged, group, ["_at", "_kind", choice], lasts={"_giver": "alias"}, threshold=threshold).where(F.col("_kind") == 1)
    filled = filled.withColumn("cut", F.col("size") - F.col("_gap"))
    # the last gap that starts before a piece ends: what it lacks is filled by the next heavy choice
    merged = (heavy.select(*line, F.col("_end").alias("_at"), F.lit(0).alias("_kind"), nothing.cast(_BIG).alias("_used"))
              .unionByName(light.select(*line, (F.col("_end") - F.col("_gap")).cast(_BIG).alias("_at"), F.lit(1).alias("_kind"), F.col("_end").alias("_used"))))
    spent = running(merged, group, ["_at", "_kind", choice], lasts={"_used": "_spent"}, threshold=threshold).where(F.col("_kind") == 0)
    spent = with_next(spent, group, ["_end"], {choice: "alias"}, threshold=threshold)
    spent = spent.withColumn("cut", F.col("size") - F.greatest(F.lit(0).cast(_BIG), F.coalesce(F.col("_spent"), F.lit(0)) - F.col("_end")))
    even = even.withColumn("cut", F.col("size")).withColumn("alias", F.col(choice))
    out = [group, "slot", choice, F.col("cut").cast("bigint").alias("cut"), F.coalesce("alias", choice).alias("alias"), "size", "n"]
    return filled.select(*out).unionByName(spent.select(*out)).unionByName(even.select(*out))


def alias_draw(table: DataFrame, draws: DataFrame, group: str, choice: str, slot_u: str = "_u", cut_u: str = "_v",
               threshold: int = HOT_KEY_ROWS) -> DataFrame:
    """Draws (group, two uniforms in [0, 1), ...) with the ``choice`` drawn;
    draws of a group without choices are left out."""
    sizes = table.groupBy(group).agg(F.max("n").alias("_n"))
    asked = join_per_key(draws, sizes, group, "inner", threshold)
    slot = F.least(F.floor(F.col(slot_u) * F.col("_n")), F.col("_n") - 1).cast("bigint")
    right = table.select(F.col(group).alias("_ag"), F.col("slot").alias("_as"), F.col(choice).alias("_own"), "cut", "alias", "size")
    joined = asked.withColumn("_slot", slot).join(right, F.col(group).eqNullSafe(F.col("_ag")) & (F.col("_slot") == F.col("_as")))
    drawn = F.when(F.col(cut_u) * F.col("size") < F.col("cut"), F.col("_own")).otherwise(F.col("alias"))
    return joined.select(*draws.columns, drawn.alias(choice))
