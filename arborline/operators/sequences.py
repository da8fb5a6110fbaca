"""Season sequences of entities: flips, transitions, streaks, masks and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborline.checkpoints import checkpointed
from arborline.functions import scalars as S
from arborline.functions.scalars import num

MOST_STREAK = 8
#: Seasons of a mask that is one number, and bits of a word of longer masks.
MOST_SEASONS, WORD_BITS = 63, 64


def _order():
    return Window.partitionBy("orch_id").orderBy("season_sort")


def with_previous(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add prev_<column> of the entity's season before, whatever gap lies between."""
    return df.withColumns({f"prev_{c}": F.lag(c).over(_order()) for c in columns})


def flips(assigned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row for each two consecutive seasons of an entity: whether its cluster changed, how far it moved, and that in words."""
    moved = with_previous(assigned, ["season_sort", "cluster", *columns]).where("prev_season_sort is not null")
    d = S.distance([F.col(c) for c in columns], [F.col(f"prev_{c}") for c in columns])
    out = moved.select("orch_id", F.col("prev_season_sort").alias("season_from"), F.col("season_sort").alias("season_to"), (F.col("cluster") != F.col("prev_cluster")).cast("int").alias("flip"), d.alias("distance"))
    return out.withColumn("magnitude", S.flip_magnitude(F.col("distance")))


def transitions(assigned: DataFrame) -> DataFrame:
    """How many entities went from one cluster to another, by season."""
    moved = with_previous(assigned, ["cluster"]).where("prev_cluster is not null")
    return moved.groupBy("season_sort", F.col("prev_cluster").alias("from_cluster"), F.col("cluster").alias("to_cluster")).agg(F.count(F.lit(1)).alias("n"))


def streaks_so_far(assigned: DataFrame, columns: Sequence[str], role: str = "cluster_role") -> DataFrame:
    """Add streak_len_current, time_since_last_flip, flip_style_last, delta_last and cover_streak_1y to 8y.

    Streaks count an entity's rows of one role in a row; gaps between seasons don't end them. A flip is a change of cluster; the time since
    it counts seasons, and is null before the first.
    """
    w = _order()
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = with_previous(assigned, ["cluster", role, *columns])
    new = (F.col(f"prev_{role}").isNull() | (F.col(f"prev_{role}") != F.col(role))).cast("int")
    flipped = F.col("cluster") != F.col("prev_cluster")
    moved = S.distance([F.col(c) for c in columns], [F.col(f"prev_{c}") for c in columns])
    df = df.withColumns({"island__": F.sum(new).over(upto), "last__": F.last(F.when(flipped, F.col("season_sort")), ignorenulls=True).over(upto)})
    run = F.row_number().over(Window.partitionBy("orch_id", "island__").orderBy("season_sort"))
    df = df.withColumn("streak_len_current", run)
    out = df.withColumns({
        "time_since_last_flip": (F.col("season_sort") - F.col("last__")).cast("double"),
        "flip_style_last": F.when(flipped, S.flip_magnitude(moved)).otherwise(""),
        "delta_last": F.when(flipped, moved),
        **{f"cover_streak_{n}y": ((F.col(role) == "Cover Crops") & (F.col("streak_len_current") >= n)).cast("int") for n in range(1, MOST_STREAK + 1)},
    })
    return out.drop("island__", "last__", *[f"prev_{c}" for c in ("cluster", role, *columns)])


def cover_masks(served: DataFrame, seasons: Sequence[int], threshold: float = 0.15) -> DataFrame:
    """(orch_id, mask, longest, years_active, ever_cover, never_cover) of entities with a confident cover season.

    Bit i of the mask is the i-th of all seasons, the earliest first; a missing season ends a run. Of more than MOST_SEASONS seasons the mask is an array of
    words of WORD_BITS bits, the earliest first; runs go on from word to word. Only if no row is a confident cover, all entities are listed, with zeros.
    """
    words = -(-len(seasons) // WORD_BITS) if len(seasons) > MOST_SEASONS else 0
    at = F.map_from_arrays(F.array(*[F.lit(int(s)) for s in seasons]), F.array(*[F.lit(i) for i in range(len(seasons))])) if seasons else F.lit(None).cast("map<int,int>")
    index = F.try_element_at(at, F.col("season_sort").cast("int"))
    sure = served.where((F.col("cluster_role") == "Cover Crops") & (F.coalesce("best_soft_norm", num(0)) > threshold)).select("orch_id", index.alias("i")).where("i is not null and orch_id is not null").distinct()
    island = F.col("i") - F.row_number().over(Window.partitionBy("orch_id").orderBy("i"))
    bits = [F.expr(f"bit_or(case when i div {WORD_BITS} = {w} then shiftleft(1L, i % {WORD_BITS}) else 0L end)").alias(f"m{w}") for w in range(max(1, words))]
    runs = sure.withColumn("g", island).groupBy("orch_id", "g").agg(F.count(F.lit(1)).alias("n"), *bits)
    whole = [F.expr(f"bit_or(m{w})") for w in range(max(1, words))]
    mask = F.array(*whole) if words else whole[0]
    found = checkpointed(runs.groupBy("orch_id").agg(mask.alias("mask"), F.max("n").alias("longest"), F.sum("n").alias("years_active")))
    if found.isEmpty():
        zero = F.lit(0).cast("long")
        none = F.array(*[zero] * words) if words else zero
        found = served.where("orch_id is not null").select("orch_id").distinct().select("orch_id", none.alias("mask"), zero.alias("longest"), zero.alias("years_active"))
    return found.withColumns({"ever_cover": F.col("years_active") > 0, "never_cover": F.col("years_active") == 0})


def profiles(assigned: DataFrame) -> DataFrame:
    """Per entity: seasons, the commonest label (ties: the first by name), flips with the first season counted as one, and without, and the uncertain rate."""
    moved = with_previous(assigned, ["cluster"])
    changed = F.col("cluster") != F.col("prev_cluster")
    per_label = Window.partitionBy("orch_id").orderBy(F.desc("n"), F.asc_nulls_last("label"))
    commonest = assigned.where("label is not null").groupBy("orch_id", "label").agg(F.count(F.lit(1)).alias("n")).withColumn("r", F.row_number().over(per_label)).where("r = 1").select("orch_id", F.col("label").alias("majority_cover_label"))
    base = moved.groupBy("orch_id").agg(
        F.count(F.lit(1)).alias("n_seasons"), F.sum((F.col("prev_cluster").isNull() | changed).cast("int")).alias("flip_count"),
        F.sum(F.coalesce(changed, F.lit(False)).cast("int")).alias("n_transitions"), F.avg("uncertain").alias("uncertain_rate"),
    )
    return base.join(commonest, "orch_id", "left")
