"""Sharding by balanced label propagation: rows of one group gather in a shard, shards keep equal row counts.

Rows with a common key (here equal texts) are linked. Linked rows start dealt out evenly, group by group; in each round
every group counts its rows per shard, and its rows elsewhere ask to move to the shard that has most of
them among those with room, or, after a round without a move, among all. From one shard to another as
many move, by rank, as come the other way, and more as far as the quota has places; so a group larger than
a shard fills one after another, and full shards still exchange rows. Two rounds without a move end it. Rows
without a link then fill every shard exactly to its quota, so counts differ by one at most (law `rows`).

Edges are never listed: a group of n rows is n rows and at most as many counts as there are shards,
summed before they are shuffled. Only counts per shard reach the driver.

Defined cases: a null text has no bytes and counts as empty; null texts and empty ones are one group;
repeated rows are rows of one group; null ids are dealt like others; fewer rows than shards leave
shards empty; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filinglake.llm import common

SHARDS = 24
ROUNDS = 24
LAW = "rows"
PART_ROWS = 100_000


def _of_shard(numbers: list[int], shard: Column) -> Column:
    return F.array(*[F.lit(n).cast("long") for n in numbers])[shard]


def _loads(state: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _allowed(asked: list, free: list[int]) -> list[int]:
    """How many rows may move from shard s to t, at s * shards + t, given how many ask to."""
    shards = len(free)
    wish = [[0] * shards for _ in free]
    for r in asked:
        wish[r["shard"]][r["target"]] = r["n"]
    out = []
    left = list(free)
    for s in range(shards):
        for t in range(shards):
            more = min(wish[s][t] - min(wish[s][t], wish[t][s]), left[t])
            left[t] -= more
            out.append(min(wish[s][t], wish[t][s]) + more)
    return out


def _moved(state: DataFrame, free: list[int], parts: int, turn: int, anywhere: bool) -> DataFrame:
    """`state` with the shard each row has after one round, and whether it moved; ties fall anew in each round."""
    counts = state.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
    rated = F.struct(F.col("n"), F.xxhash64("group", "shard", F.lit(turn)).alias("tie"), F.col("shard"))
    room = F.lit(True) if anywhere else _of_shard(free, F.col("shard")) > 0
    best = counts.groupBy("group").agg(F.max(F.when(room, rated)).alias("best"))
    asked = (
        state.join(counts.withColumn("own", rated).select("group", "shard", "own"), ["group", "shard"])
        .join(best, "group")
        .withColumn("target", F.when((F.col("best") > F.col("own")), F.col("best.shard")))
        .drop("best", "own")
    )
    wishes = asked.where("target IS NOT NULL")
    # At most one row for each pair of shards.
    limits = _allowed(wishes.groupBy("shard", "target").agg(F.count(F.lit(1)).alias("n")).collect(), free)
    movers = common.ranked(wishes, ["shard", "target"], ["group", "doc_id"], "rank", parts)
    allowed = F.col("rank") < _of_shard(limits, F.col("shard") * len(free) + F.col("target"))
    let_in = movers.withColumn("moved", allowed).withColumn("shard", F.when(allowed, F.col("target")).otherwise(F.col("shard")))
    stay = asked.where("target IS NULL").withColumn("moved", F.lit(False))
    kept = [*state.columns, "moved"]
    return stay.select(*kept).union(let_in.select(*kept))


def _in_line(linked: DataFrame, shards: int, total: int, parts: int) -> DataFrame:
    """Linked rows dealt out evenly with groups one behind another, so few groups start in several shards.

    A group's place in the line is the sum of the groups before it: within a part by a window, and of whole
    parts by another over one row a part; rows are ranked within their group.
    """
    sizes = linked.groupBy("group").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.pmod(F.xxhash64("group"), F.lit(parts)))
    ahead = lambda name, window: F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = sizes.withColumn("inner", ahead("n", Window.partitionBy("part").orderBy("group")))
    outer = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", ahead("n", Window.orderBy("part")).alias("outer"))
    starts = inner.join(outer, "part").select("group", (F.col("inner") + F.col("outer")).alias("start"))
    ranks = common.ranked(linked, ["group"], ["doc_id"], "rank", parts)
    place = F.col("start") + F.col("rank")
    # The first shards take one row more, as in the quotas, so no load is above its quota.
    each, more = divmod(total, shards)
    larger = more * (each + 1)
    shard = F.when(place < larger, F.floor(place / (each + 1))).otherwise(more + F.floor((place - larger) / max(each, 1)))
    return ranks.join(starts, "group").select(*linked.columns, shard.cast("int").alias("shard"))


def propagate(linked: DataFrame, quotas: list[int], rounds: int | None = None, in_line: bool = True) -> DataFrame:
    """Rows (with `group` and `doc_id`) and the shard each ends in; no shard gets more than its quota."""
    shards, total = len(quotas), linked.count()
    parts = max(8, total // PART_ROWS)
    if in_line:
        dealt = _in_line(linked, shards, total, parts)
    else:
        ranks = common.ranked(linked, [], ["group", "doc_id"], "rank", parts)
        dealt = ranks.withColumn("shard", (F.col("rank") % shards).cast("int")).drop("rank")
    state = common.land(dealt, "shard-start")
    quiet = 0
    for turn in range(ROUNDS if rounds is None else rounds):
        free = [quota - load for quota, load in zip(quotas, _loads(state, shards), strict=True)]
        after = common.land(_moved(state, free, parts, turn, quiet > 0), f"shard-round{turn}")
        if turn:
            common.discard(before)
        before, state = after, after.drop("moved")
        quiet = quiet + 1 if after.where("moved").isEmpty() else 0
        if quiet == 2:
            break
    return state


def assign(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """`rows` (doc_id, group and others) with their shard: equal counts, groups together where they fit."""
    sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    shared = common.land(sizes.where("n > 1").select("group"), "shard-groups")
    total = rows.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    placed = propagate(rows.join(shared, "group", "left_semi"), quotas)
    loads = _loads(placed, shards)
    single = rows.join(shared, "group", "left_anti")
    dealt = common.ranked(single, [], ["group", "doc_id"], "rank", max(8, total // PART_ROWS))
    ends, before = [], 0
    for quota, load in zip(quotas, loads, strict=True):
        before += quota - load
        ends.append(before)
    full = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.col("rank")))
    filled = dealt.withColumn("shard", full.cast("int")).drop("rank")
    return placed.select(*rows.columns, "shard").union(filled.select(*rows.columns, "shard"))


def cut_groups(assigned: DataFrame) -> DataFrame:
    """Groups that lie in several shards, and in how many."""
    spread = assigned.groupBy("group").agg(F.countDistinct("shard").alias("shards"))
    return spread.where("shards > 1")


def shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law) of every row."""
    rows = common.land(
        documents.select(
            F.col("doc_id").cast("long"),
            (F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("long").alias("size"),
            common.checksum(F.col("text")).alias("text_crc32"),
            common.digest(F.col("text")).alias("group"),
        ),
        "shard-rows",
    )
    assigned = common.land(assign(rows, shards), "shard-assigned")
    slots = common.ranked(assigned, ["shard"], ["doc_id", "group"], "slot", max(8, rows.count() // (shards * PART_ROWS)))
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
