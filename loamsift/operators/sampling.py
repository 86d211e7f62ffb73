"""Batches drawn by domain or by attribute.

Groups are a table (a name, a place, a count and a weight each) of any length, broadcast only
where it has few rows. The documents stay distributed: each gets a dense rank in its group,
and a drawn (group, rank) is joined to it. Draws depend on the seed and the draw number
alone, so a retried task or another partitioning gives the same batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loamsift.config import SamplingConfig
from loamsift.functions.lookup import weight_of
from loamsift.functions.seeded import uniform
from loamsift.operators.keyed_join import spread_join
from loamsift.operators.ranking import add_rank
from loamsift.operators.staging import new_path, stage

FEW_GROUPS = 10_000  # that many rows of a group table may be broadcast
CELLS = 4096  # equal parts of [0, 1) by which draws meet the groups
MEMBERS = 1 << 20  # places of a group in a block of an index
MAX_BROADCAST_DRAWS = 200_000


def group_statistics(df: DataFrame, by: str = "domain") -> DataFrame:
    """(by, count, proportion, first_id) of each group; a missing name is 'unknown'."""
    counts = df.groupBy(F.coalesce(by, F.lit("unknown")).alias(by)).agg(
        F.count("*").alias("count"), F.min("doc_id").alias("first_id")
    )
    # One row per group.
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts.select(by, "count", (F.col("count") / total).alias("proportion"), "first_id")


def unimax_weights(stats: DataFrame, by: str = "domain") -> DataFrame:
    return stats.select(by, (F.lit(1.0) / F.count("*").over(Window.partitionBy(F.lit(0)))).alias("weight"))


def alpha_weights(stats: DataFrame, alpha: float = 1.3, by: str = "domain") -> DataFrame:
    powered = F.pow("proportion", F.lit(alpha))
    return stats.select(by, (powered / F.sum(powered).over(Window.partitionBy(F.lit(0)))).alias("weight"))


def preference_weights(
    stats: DataFrame, preferences: dict[str, float], cfg: SamplingConfig = SamplingConfig(), by: str = "domain"
) -> DataFrame:
    """Preferences scaled to sum to one, of the groups there are; a small weight for any other."""
    total = sum(preferences.values())
    scaled = {name: value / total for name, value in preferences.items()}
    return stats.select(by, weight_of(F.col(by), scaled, cfg.absent_preference).alias("weight"))


def bucket_key(fine: bool = True) -> Column:
    quality = F.coalesce("quality", F.lit("medium"))
    return F.concat_ws("_", F.coalesce("domain", F.lit("unknown")), quality) if fine else quality


def with_buckets(df: DataFrame, fine: bool = True) -> DataFrame:
    """(doc_id, bucket) by domain and quality, or by quality alone."""
    return df.select("doc_id", bucket_key(fine).alias("bucket"))


def bucket_weights(stats: DataFrame, cfg: SamplingConfig = SamplingConfig()) -> DataFrame:
    """Weight of the bucket's quality times the bucket's share, scaled to sum to one."""
    quality = F.substring_index("bucket", "_", -1)
    scaled = weight_of(quality, cfg.quality_weights, cfg.other_quality_weight) * F.col("proportion")
    return stats.select("bucket", (scaled / F.sum(scaled).over(Window.partitionBy(F.lit(0)))).alias("weight"))


def fit_groups(stats: DataFrame, weights: DataFrame, by: str = "domain") -> DataFrame:
    """The groups in order of first appearance: (by, index, count, weight)."""
    ranked = add_rank(stats.join(weights, by).select(by, "first_id", "count", "weight"), [F.col("first_id"), F.col(by)], "index")
    return stage(ranked.drop("first_id"), "fitted_groups")


def _few(groups: DataFrame) -> DataFrame:
    return F.broadcast(groups) if groups.count() <= FEW_GROUPS else groups


def _named(df: DataFrame, by: str) -> DataFrame:
    return df.select("doc_id", F.coalesce(by, F.lit("unknown")).alias(by))


# --- round robin -----------------------------------------------------------------------


def _turns(length, index, n: int):
    """How many of the first ``length`` positions fall to group ``index`` of ``n``."""
    return np.maximum(0, -(-(length - index) // n))


def _stretches(left: np.ndarray, size: int, n_batches: int) -> list[tuple[int, int, int]]:
    """(first batch, batches, length): a batch fills round by round until a group has none left for its turn.

    Batches stay alike until a group runs short, so there are at most two stretches a group.
    """
    n, index = len(left), np.arange(len(left))
    first, found = 0, []
    while n and first < n_batches:
        length = int(min(size, (left * n + index).min()))
        if length == 0:
            break
        turns = _turns(length, index, n)
        # Later batches are never longer, so the last one that is as long is found by halving.
        alike, beyond = 1, 1 + int(min(n_batches - first, (left[turns > 0] // turns[turns > 0]).min()))
        while beyond - alike > 1:
            middle = (alike + beyond) // 2
            if int(min(size, ((left - (middle - 1) * turns) * n + index).min())) == length:
                alike = middle
            else:
                beyond = middle
        found.append((first, alike, length))
        left, first = left - alike * turns, first + alike
    return found


def _slots(spark: SparkSession, stretches: list[tuple[int, int, int]], n: int) -> DataFrame:
    """(batch_id, position, index, rank) of every place of the batches: which of a group's documents belongs there.

    Places are numbers of one range. A task finds the stretches of its own and what earlier ones took of each
    group from the list of stretches (a few numbers each, at most two stretches a group).
    """
    table = np.array(stretches, np.int64).reshape(-1, 3)
    first, batches, length = table.T
    begins = np.concatenate([[0], np.cumsum(batches * length)])

    def turns(length, index):  # as ``_turns``, but sent with the function that tasks apply
        return np.maximum(0, -(-(length - index) // n))

    def placed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, taken, index = -1, np.zeros(n, np.int64), np.arange(n)
        for frame in frames:
            ids = frame.column(0).to_numpy()
            for stretch in np.unique(np.searchsorted(begins, ids, "right") - 1).tolist():
                if stretch < at:
                    at, taken = -1, np.zeros(n, np.int64)
                for earlier in range(max(at, 0), stretch):
                    taken += batches[earlier] * turns(length[earlier], index)
                at = stretch
                own = ids[(ids >= begins[stretch]) & (ids < begins[stretch + 1])] - begins[stretch]
                batch, position = own // length[stretch], own % length[stretch]
                rank = taken[position % n] + batch * turns(length[stretch], position % n) + position // n
                columns = (first[stretch] + batch, position, position % n, rank)
                yield pa.record_batch([pa.array(x) for x in columns], ["batch_id", "position", "index", "rank"])

    return spark.range(int(begins[-1])).mapInArrow(placed, "batch_id bigint, position bigint, index bigint, rank bigint")


def _shuffled(ids: DataFrame, by: str, groups: DataFrame, cfg: SamplingConfig) -> DataFrame:
    """(doc_id, index, rank): seeded order within each group, epoch after epoch.

    ``groups`` says by ``need`` how many ranks of each are used. Where that is a small part of
    it only rows below a cut are sorted. The cut is checked by counting and dropped if it was
    too low, so it never changes the result.
    """
    draw = ids.select("doc_id", by, F.explode(F.sequence(F.lit(0), F.lit(cfg.max_epochs - 1))).alias("_epoch"))
    draw = draw.withColumn("_u", uniform(cfg.seed, F.col("_epoch"), F.col("doc_id")))
    share = (F.col("need") + 10 * F.sqrt("need") + 100) / F.col("count")
    limits = groups.select(by, "index", F.when(F.col("need") <= F.col("count"), share).otherwise(2.0).alias("_share"))
    draw = _with_groups(draw, limits, by)
    cut = stage(draw.where(F.col("_u") < F.col("_share")).drop("_share"), "below_cut")
    held = cut.where("_epoch = 0").groupBy("index").agg(F.count("*").alias("_held"))
    short = groups.join(held, "index", "left").where(F.coalesce("_held", F.lit(0)) < F.least("need", "count"))
    order = [F.col("_epoch"), F.col("_u"), F.col("doc_id")]
    return add_rank(cut if short.isEmpty() else draw.drop("_share"), order, within="index").drop("_epoch", "_u")


def _with_groups(rows: DataFrame, groups: DataFrame, by: str) -> DataFrame:
    """Attach group columns; a group that holds a large part of the rows is split where the table isn't broadcast."""
    few = _few(groups)
    return rows.join(few, by) if few is not groups else spread_join(rows, groups, by, "doc_id")


def unimax_run(
    df: DataFrame, size: int, n_batches: int, cfg: SamplingConfig = SamplingConfig(), by: str = "domain", state: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The next ``n_batches`` batches (batch_id, position, doc_id, by), and the state to go on from.

    Groups take turns, each in its own shuffled order, which goes on from batch to batch. A batch ends early
    when it is the turn of a group that has gone through all its epochs. ``state`` is a written table
    (by, taken, batches) of an earlier run over the same documents: the order goes on where that one stopped.
    """
    spark = df.sparkSession
    stats = stage(group_statistics(df, by), "groups")
    groups = fit_groups(stats, unimax_weights(stats, by), by)
    if state is None:
        known = groups.select(by, "index", "count", F.lit(0).cast("bigint").alias("taken"), F.lit(0).cast("bigint").alias("batches"))
    else:
        known = groups.join(state, by, "left").select(
            by, "index", "count", F.coalesce("taken", F.lit(0)).alias("taken"), F.coalesce("batches", F.lit(0)).alias("batches")
        )
    # Three numbers per group come to the driver, never one per batch.
    rows = known.select("index", "count", "taken", "batches").orderBy("index").toArrow()
    counts, taken = (rows.column(name).to_numpy() for name in ("count", "taken"))
    n, before = len(counts), int(max(rows.column("batches").to_pylist(), default=0))
    stretches = _stretches(cfg.max_epochs * counts - taken, size, n_batches)
    used = taken.copy()
    for _, batches, length in stretches:
        used += batches * _turns(length, np.arange(n), n)
    done = sum(batches for _, batches, _ in stretches)
    after = spark.createDataFrame(pa.table({"index": np.arange(n), "taken": taken, "need": used}), "index bigint, taken bigint, need bigint")
    after = stage(known.select(by, "index", "count").join(after, "index"), "round_robin")
    ranked = _shuffled(_named(df, by), by, after.select(by, "index", "count", "need"), cfg)
    ranked = ranked.join(_few(after.select("index", "taken")), "index").withColumn("rank", F.col("rank") - F.col("taken")).drop("taken")
    found = _slots(spark, stretches, n).join(ranked, ["index", "rank"])
    batch = (F.col("batch_id") + before).cast("int").alias("batch_id")
    state = after.select(by, F.col("need").alias("taken"), F.lit(before + done).cast("bigint").alias("batches"))
    return found.select(batch, "position", "doc_id", by), state


def unimax_batches(
    df: DataFrame, size: int, n_batches: int = 1, cfg: SamplingConfig = SamplingConfig(), by: str = "domain"
) -> DataFrame:
    """(batch_id, position, doc_id, by): the first batches of a round-robin order."""
    return unimax_run(df, size, n_batches, cfg, by)[0]


def unimax_batch(df: DataFrame, size: int, cfg: SamplingConfig = SamplingConfig(), by: str = "domain") -> DataFrame:
    return unimax_batches(df, size, 1, cfg, by).drop("batch_id")


# --- weighted draws with replacement ---------------------------------------------------


def _cells(groups: DataFrame, by: str) -> DataFrame:
    """The groups as intervals of [0, 1) by their ``mass``, once for each equal cell that they reach into; written."""
    upto = Window.orderBy("index")  # one row per group
    total = F.sum("mass").over(Window.partitionBy(F.lit(0)))
    ends = groups.withColumn("_run", F.sum("mass").over(upto)).withColumns({
        "_last": F.lead("index").over(upto).isNull(), "_end": F.col("_run") / total,
    })
    ends = ends.withColumn("_begin", F.coalesce(F.lag("_end").over(upto), F.lit(0.0)))
    ends = ends.withColumn("_end", F.when(F.col("_last"), 2.0).otherwise(F.col("_end")))
    reach = F.sequence(_cell(F.col("_begin")), _cell(F.col("_end")))
    return stage(ends.select(by, "index", "count", "_begin", "_end", F.explode(reach).alias("_cell")), "group_cells")


def _cell(x: Column) -> Column:
    return F.least(F.floor(x * CELLS), F.lit(CELLS - 1)).cast("bigint")


def _picks(cells: DataFrame, by: str, first: int, n_draws: int, seed: int) -> DataFrame:
    """(draw, by, rank) of the draws from number ``first`` on: a group by its mass, then a place in it evenly."""
    draws = cells.sparkSession.range(first, first + n_draws).select(
        F.col("id").alias("draw"),
        uniform(f"{seed}:group", F.col("id")).alias("_u"),
        uniform(f"{seed}:member", F.col("id")).alias("_v"),
    ).withColumn("_cell", _cell(F.col("_u")))
    return draws.join(F.broadcast(cells) if cells.count() <= FEW_GROUPS else cells, "_cell").where(
        (F.col("_begin") <= F.col("_u")) & (F.col("_u") < F.col("_end"))
    ).select("draw", by, F.floor(F.col("_v") * F.col("count")).alias("rank"))


def _members(df: DataFrame, by: str) -> DataFrame:
    """(doc_id, by, rank): each document's place in its group, in the order of ids."""
    return add_rank(_named(df, by), [F.col("doc_id")], within=by)


def weighted_draws(df: DataFrame, by: str, groups: DataFrame, n_draws: int, seed: int) -> DataFrame:
    """(draw, doc_id, by): a group by its ``mass``, then one of its documents evenly.

    Groups are intervals of [0, 1); draws and intervals meet by the equal cells that they fall into.
    """
    picked = _picks(_cells(groups, by), by, 0, n_draws, seed)
    return picked.join(_members(df, by), [by, "rank"]).select("draw", "doc_id", by)


@dataclass(frozen=True)
class DrawIndex:
    """What draws from a corpus need, written once: the groups' cells, and the members in blocks of ``MEMBERS`` places of a group."""

    cells: DataFrame
    members: DataFrame
    by: str
    seed: int

    def draws(self, first: int, n_draws: int) -> DataFrame:
        """(draw, doc_id, by) of the draws with the numbers ``first`` to ``first + n_draws - 1``.

        They are the same in whatever batches they are taken. Only the blocks that they fall into are read, and nothing is sorted.
        """
        picked = _picks(self.cells, self.by, first, n_draws, self.seed).withColumn("block", F.floor(F.col("rank") / MEMBERS))
        picked = stage(picked, "picks")
        few = F.broadcast(picked) if n_draws <= MAX_BROADCAST_DRAWS else picked
        return self.members.join(few, ["block", self.by, "rank"]).select("draw", "doc_id", self.by)


def draw_index(df: DataFrame, groups: DataFrame, seed: int, by: str = "domain") -> DrawIndex:
    """The index for draws from ``df`` by ``groups`` (``fit_groups`` with a column ``mass``)."""
    path, spark = new_path(df.sparkSession, "members"), df.sparkSession
    members = _members(df, by).withColumn("block", F.floor(F.col("rank") / MEMBERS))
    # A block of every group lies in one folder, so that those which no draw falls into are passed over.
    members.repartition("block", by).sortWithinPartitions("block", by, "rank").write.partitionBy("block").parquet(path)
    schema = f"doc_id bigint, `{by}` string, rank bigint, block bigint"
    return DrawIndex(_cells(groups, by), spark.read.schema(schema).parquet(path), by, seed)


def alpha_index(df: DataFrame, cfg: SamplingConfig = SamplingConfig(), by: str = "domain") -> DrawIndex:
    """The index for draws as ``alpha_batch`` makes them."""
    stats = stage(group_statistics(df, by), "groups")
    groups = fit_groups(stats, alpha_weights(stats, cfg.alpha, by), by)
    return draw_index(df, groups.withColumn("mass", F.col("weight") * F.col("count")), cfg.seed, by)


def _document_weighted(
    df: DataFrame, weights: DataFrame, stats: DataFrame, size: int, cfg: SamplingConfig, by: str, documented: bool
) -> DataFrame:
    """Draws in which every document has the weight of its group.

    A group's mass is then its weight times its size; ``documented`` takes the weight alone.
    """
    groups = fit_groups(stats, weights, by)
    mass = F.col("weight") * (F.lit(1) if documented else F.col("count"))
    n_draws = min(size, groups.agg(F.sum("count")).first()[0] or 0)
    return weighted_draws(df, by, groups.withColumn("mass", mass), n_draws, cfg.seed)


def alpha_batch(
    df: DataFrame, size: int, cfg: SamplingConfig = SamplingConfig(), by: str = "domain", documented: bool = False
) -> DataFrame:
    stats = stage(group_statistics(df, by), "groups")
    return _document_weighted(df, alpha_weights(stats, cfg.alpha, by), stats, size, cfg, by, documented)


def preference_batch(
    df: DataFrame,
    preferences: dict[str, float],
    size: int,
    cfg: SamplingConfig = SamplingConfig(),
    by: str = "domain",
    documented: bool = False,
) -> DataFrame:
    stats = stage(group_statistics(df, by), "groups")
    weights = preference_weights(stats, preferences, cfg, by)
    return _document_weighted(df, weights, stats, size, cfg, by, documented)


def attribute_batch(df: DataFrame, size: int, cfg: SamplingConfig = SamplingConfig(), fine: bool = True) -> DataFrame:
    """Draws by bucket weight; the batch may be larger than the corpus."""
    buckets = with_buckets(df, fine)
    stats = stage(group_statistics(buckets, "bucket"), "groups")
    groups = fit_groups(stats, bucket_weights(stats, cfg), "bucket")
    return weighted_draws(buckets, "bucket", groups.withColumn("mass", F.col("weight")), size, cfg.seed)


# --- choice of method ------------------------------------------------------------------


def method_for(method: str, domain: str | None = None) -> str:
    """The method that a request leads to: English text and unknown names mean ``unimax``."""
    if domain == "english" or method == "unimax":
        return "unimax"
    if domain == "code" or method == "alpha":
        return "alpha"
    return method if method in ("preference", "attribute") else "unimax"


def method_by_composition(df: DataFrame, cfg: SamplingConfig = SamplingConfig()) -> DataFrame:
    """One row (rows, code_rows, method): alpha for a corpus with much code, else unimax."""
    counted = df.agg(F.count("*").alias("rows"), F.count_if(F.col("domain") == "code").alias("code_rows"))
    much = F.col("code_rows") > F.lit(cfg.code_share_for_alpha) * F.col("rows")
    return counted.withColumn("method", F.when(much, "alpha").otherwise("unimax"))


def draw_batch(
    df: DataFrame,
    size: int,
    cfg: SamplingConfig = SamplingConfig(),
    domain: str | None = None,
    preferences: dict[str, float] | None = None,
    fine: bool = True,
) -> DataFrame:
    """A batch by the method that ``cfg.method`` and ``domain`` lead to."""
    method = method_for(cfg.method, domain)
    if method == "alpha":
        return alpha_batch(df, size, cfg)
    if method == "preference":
        return preference_batch(df, preferences or {}, size, cfg)
    if method == "attribute":
        return attribute_batch(df, size, cfg, fine)
    return unimax_batch(df, size, cfg)


def with_sampling_weight(df: DataFrame, cfg: SamplingConfig = SamplingConfig(), by: str = "domain") -> DataFrame:
    """The sampling step: every row, with the weight of its group under the chosen method."""
    stats = stage(group_statistics(df, by), "groups")
    method = method_by_composition(df, cfg).first()["method"]
    weights = alpha_weights(stats, cfg.alpha, by) if method == "alpha" else unimax_weights(stats, by)
    named = df.withColumn("_group", F.coalesce(by, F.lit("unknown")))
    known = stage(weights.select(F.col(by).alias("_group"), F.col("weight").alias("sampling_weight")), "group_weights")
    weighted = _with_groups(named.drop("sampling_weight"), known, "_group")
    return weighted.select(*[c for c in df.columns if c != "sampling_weight"], F.lit(method).alias("sampling_method"), "sampling_weight")
