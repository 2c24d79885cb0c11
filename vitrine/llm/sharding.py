"""Documents put into equal shards so that linked documents share one.

Documents are linked through groups (here: equal texts).  Balanced label
propagation works on cells, the documents of one group in one shard, so a
group that holds a third of all rows is a handful of rows.  Each round every
cell asks to move to the shard that holds most of its group; a shard accepts
the largest requests while they fit its room and what leaves it in the same
round, so labels spread along links also where nearly all rows are linked.
The rounds end when hardly a request is granted; a group still cut that a shard
can hold is then put whole into a shard with room.  A shard may hold a little
more than its size meanwhile; whole cells then leave it, and fewer than one
group a shard is cut to fill the shards exactly.  Documents without a link fill what is left.
Counts come out at most one apart: what a shard holds above its size moves,
from the unlinked end of its order, to shards with room.

Numbers are given without putting a shard, a group or the table into one task:
rows are dealt into hash buckets, numbered inside each, and the bucket totals
(a few thousand rows) are summed up.

Null texts are empty texts and form one group.  Rows with a repeated ``doc_id``
are separate rows.  An empty table gives an empty result.  Extra columns are
not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.llm.common import plain_text
from vitrine.sources.scratch import cut_lineage

SHARDS = 16
#: A cell larger than this part of a shard may move in part.
LARGE_PART = 64
#: While labels spread, a shard may hold this part more than its size, and so many rows at least.
SLACK_PART = 50
LEAST_SLACK = 4
#: Rounds end when less than one in so many requested rows moved; groups still cut are then gathered (``fitted``).
LEAST_GRANTED = 16
BUCKET_ROWS = 50_000


def _shard_of(key: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("start")), F.lit(shards)).cast("int")


def numbered(df: DataFrame, by: list[str], order: list[str], number: str, rows: int) -> DataFrame:
    """Numbers from 0 without gaps within each value of ``by`` (few values).

    ``order`` holds columns whose leading one cuts the order into buckets: rows
    are numbered inside ``(by, bucket)`` and bucket totals are added.
    """
    buckets = max(8, rows // BUCKET_ROWS)
    # a hash of its own: the one that chose the shard would put a shard's rows into few buckets
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order, F.lit("bucket")), F.lit(buckets)).cast("int"))
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order)
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*by, "_bucket").agg(F.count("*").alias("_held")).withColumn(
        "_before", F.coalesce(F.sum("_held").over(earlier), F.lit(0))).drop("_held")
    return (dealt.withColumn("_inside", F.row_number().over(inside) - 1).join(totals, [*by, "_bucket"])
            .withColumn(number, (F.col("_before") + F.col("_inside")).cast("long"))
            .drop("_bucket", "_before", "_inside"))


def _sum_before(cells: DataFrame, by: list[str], total: int) -> DataFrame:
    """``before``: what the earlier cells of ``by`` hold.  Larger cells come first by powers of two, then a hash of the group."""
    buckets = max(8, total // BUCKET_ROWS)
    dealt = cells.withColumn("_size", -F.floor(F.log2("n"))).withColumn(
        "_bucket", F.pmod(F.xxhash64("grp"), F.lit(buckets)).cast("int"))
    inside = Window.partitionBy(*by, "_size", "_bucket").orderBy("grp", "shard").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*by).orderBy("_size", "_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*by, "_size", "_bucket").agg(F.sum("n").alias("_held")).withColumn(
        "_earlier", F.coalesce(F.sum("_held").over(earlier), F.lit(0))).drop("_held")
    return (dealt.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(totals, [*by, "_size", "_bucket"])
            .withColumn("before", F.col("_earlier") + F.col("_inside")).drop("_size", "_bucket", "_earlier", "_inside"))


def quotas(wanted: list[list[int]], room: list[int]) -> list[list[int]]:
    """What may move from shard to shard: as much as is wanted while no shard takes more than its room and what leaves it."""
    flow = [list(row) for row in wanted]
    shards = range(len(room))
    cut = True
    while cut:
        cut = False
        for to in shards:
            over = sum(flow[k][to] for k in shards) - sum(flow[to]) - room[to]
            while over > 0 and any(flow[k][to] for k in shards):
                largest = max(shards, key=lambda k: flow[k][to])
                less = min(over, max(1, flow[largest][to] // 2))
                flow[largest][to] -= less
                over -= less
                cut = True
    return flow


def _loads(cells: DataFrame, shards: int) -> list[int]:
    held = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [held.get(k, 0) for k in range(shards)]


def _listed(values: list[int]) -> Column:
    return F.array(*(F.lit(v).cast("long") for v in values))


def propagate(cells: DataFrame, capacity: int, shards: int = SHARDS) -> DataFrame:
    """``grp, shard, n`` after label propagation until hardly a request is granted; totals per group stay.

    A shard may hold ``SLACK_PART`` more than the capacity meanwhile.  A whole
    cell that moves leaves one cell less, and a part goes to a cell at least as
    large, so the rounds come to an end.
    """
    large = max(1, capacity // LARGE_PART)
    most = capacity + max(LEAST_SLACK, capacity // SLACK_PART)
    total = capacity * shards
    turn = 0
    while True:
        room = [most - held for held in _loads(cells, shards)]
        placed = cells.withColumn("room", F.element_at(_listed(room), F.col("shard") + 1))
        # a group's best shard: its largest cell, among shards that still have room; ties fall anew each round
        best = placed.groupBy("grp").agg(F.max(F.when(F.col("room") > 0, F.struct(
            F.col("n"), F.xxhash64("grp", "shard", F.lit(turn)).alias("tie"), F.col("shard").alias("to")))).alias("best"))
        asked = (placed.join(best, "grp").where("best IS NOT NULL AND best.to <> shard").select(
            "grp", "shard", "n", F.col("best.to").alias("to"), ((F.col("n") > large) & (F.col("n") <= F.col("best.n"))).alias("parted")))
        wanted = [[0] * shards for _ in range(shards)]
        for r in asked.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect():
            wanted[r["shard"]][r["to"]] = r["n"]
        quota = [q for row in quotas(wanted, room) for q in row]
        if not any(quota):
            return cells
        granted = _sum_before(asked, ["shard", "to"], total).withColumn(
            "left", F.element_at(_listed(quota), F.col("shard") * shards + F.col("to") + 1) - F.col("before"))
        moves = cut_lineage(granted.where(F.col("left") >= F.when(F.col("parted"), 1).otherwise(F.col("n"))).select(
            "grp", "shard", "to", F.least("n", "left").alias("moved")))
        moved = moves.agg(F.sum("moved")).first()[0] or 0
        leaving = moves.select("grp", "shard", (-F.col("moved")).alias("n"))
        coming = moves.select("grp", F.col("to").alias("shard"), F.col("moved").alias("n"))
        cells = cut_lineage(cells.select("grp", "shard", "n").unionByName(leaving).unionByName(coming)
                            .groupBy("grp", "shard").agg(F.sum("n").alias("n")).where("n > 0"))
        if moved * LEAST_GRANTED < sum(map(sum, wanted)):
            return cells
        turn += 1


def fitted(cells: DataFrame, shares: list[int]) -> DataFrame:
    """``cells`` with no shard above its share and each group whole that a shard can hold, but for fewer than one a shard.

    Groups that are still cut leave their shards, as do whole cells of shards
    above their share.  All are laid along the rooms of the shards; only what
    lies across the end of a room may have to be cut.
    """
    shards, total = len(shares), sum(shares)
    cut = cut_lineage(cells.groupBy("grp").agg(F.sum("n").alias("n"), F.count("*").alias("cells"), F.min("shard").alias("shard"))
                      .where((F.col("cells") > 1) & (F.col("n") <= min(shares))).select("grp", "shard", "n"))
    if cut.isEmpty() and all(held <= share for held, share in zip(_loads(cells, shards), shares)):
        return cells
    share = F.element_at(_listed(shares), F.col("shard") + 1)
    parts = cut_lineage(_sum_before(cells.join(cut.select("grp"), "grp", "left_anti"), ["shard"], total).withColumn(
        "kept", F.when(F.col("before") + F.col("n") <= share, F.col("n")).when(F.col("before") == 0, share).otherwise(0)))
    kept = parts.where("kept > 0").select("grp", "shard", F.col("kept").alias("n"))
    rooms = [share - held for share, held in zip(shares, _loads(kept, shards))]
    # the rooms one after the other, and the cells that left laid along them
    ends = [sum(rooms[:k + 1]) for k in range(shards)]
    left = _sum_before(parts.where("n > kept").select("grp", "shard", (F.col("n") - F.col("kept")).alias("n"))
                       .unionByName(cut).withColumn("all", F.lit(0)), ["all"], total)
    at = F.expr("size(filter(ends, e -> e <= before))")
    laid = cut_lineage(left.withColumn("ends", _listed(ends)).withColumn("to", at).withColumn(
        "whole", F.col("before") + F.col("n") <= F.expr("ends[to]")).drop("ends"))
    fits = laid.where("whole").select("grp", F.col("to").alias("shard"), "n")
    for k, held in enumerate(_loads(fits, shards)):
        rooms[k] -= held
    # at most one cell lies across the end of each room; they go where they fit whole, or are cut
    rest = []
    for r in laid.where("NOT whole").orderBy(F.desc("n"), "grp", "shard").select("grp", "n").collect():
        n = r["n"]
        while n:
            holding = [k for k in range(shards) if rooms[k] >= n]
            to = min(holding, key=lambda k: rooms[k]) if holding else max(range(shards), key=lambda k: rooms[k])
            moved = min(n, rooms[to])
            rest.append((r["grp"], to, moved))
            rooms[to] -= moved
            n -= moved
    out = kept.unionByName(fits)
    if rest:
        lists = [F.array(*(F.lit(v[k]) for v in rest)) for k in range(3)]
        out = out.unionByName(cells.sparkSession.range(len(rest)).select(*(
            F.element_at(values, F.col("id").cast("int") + 1).cast(out.schema[name].dataType).alias(name)
            for values, name in zip(lists, ("grp", "shard", "n")))))
    return cut_lineage(out.groupBy("grp", "shard").agg(F.sum("n").alias("n")))


def balanced_shards(docs: DataFrame, group: Column, shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``; documents with an equal ``group`` are linked, null links to nothing."""
    total = docs.count()
    # a group meets its size in pieces, so that a group of a third of all rows is many keys
    rows = docs.withColumn("grp", group).withColumn(
        "_piece", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(max(8, total // BUCKET_ROWS))).cast("int"))
    held = rows.where("grp IS NOT NULL").groupBy("grp", "_piece").agg(F.count("*").alias("held"))
    sizes = held.groupBy("grp").agg(F.sum("held").alias("members")).where("members > 1")
    work = cut_lineage(rows.join(held.drop("held").join(sizes, "grp"), ["grp", "_piece"], "left").withColumn(
        "grp", F.when(F.col("members").isNotNull(), F.col("grp"))).drop("_piece"))
    capacity = max(1, total // shards)

    # linked documents: propagate on cells, then deal each group's documents out to its cells
    linked = work.where("grp IS NOT NULL").drop("members")
    start = linked.withColumn("shard", F.pmod(F.xxhash64(
        "doc_id", "text_crc32", F.lit("start")), F.lit(shards)).cast("int"))
    cells = propagate(cut_lineage(start.groupBy("grp", "shard").agg(F.count("*").alias("n"))), capacity, shards)
    cells = fitted(cells, [total // shards + (k < total % shards) for k in range(shards)])
    fill = Window.partitionBy("grp").orderBy("shard")
    spans = cells.withColumn("stop", F.sum("n").over(fill)).groupBy("grp").agg(
        F.array_sort(F.collect_list(F.struct("stop", "shard"))).alias("spans"))
    placed = _numbered_in_groups(linked, spans, total).withColumn(
        "shard", F.expr("filter(spans, s -> s.stop > member)[0].shard")).drop("spans", "member")

    # documents without a link start anywhere; they come last in their shard and level the counts
    single = work.where("grp IS NULL").drop("members").withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(shards)).cast("int"))
    state = cut_lineage(placed.unionByName(single.select(placed.columns)))
    return _level(state, total, shards)


def _numbered_in_groups(linked: DataFrame, spans: DataFrame, total: int) -> DataFrame:
    """``member``: 0.. within each group, and what ``spans`` has for the group.

    Groups above a bucket are numbered in pieces, and each piece, not the group, is
    a key of the join with the rows; ``spans`` reaches the totals of the pieces.
    """
    buckets = max(8, total // BUCKET_ROWS)
    dealt = linked.withColumn("_bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    inside = Window.partitionBy("grp", "_bucket").orderBy("doc_id", "text_crc32")
    earlier = Window.partitionBy("grp").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("grp", "_bucket").agg(F.count("*").alias("_held")).withColumn(
        "_before", F.coalesce(F.sum("_held").over(earlier), F.lit(0))).drop("_held").join(spans, "grp")
    return (dealt.withColumn("_inside", F.row_number().over(inside) - 1).join(totals, ["grp", "_bucket"])
            .withColumn("member", F.col("_before") + F.col("_inside")).drop("_bucket", "_before", "_inside"))


def _level(state: DataFrame, total: int, shards: int) -> DataFrame:
    """Counts made at most one apart, then slots.  Surplus rows leave from the unlinked ones first."""
    # a place in the shard: linked rows first, so that the surplus is unlinked where it can be
    by = state.withColumn("free", F.col("grp").isNull().cast("int"))
    counts = by.groupBy("shard", "free").agg(F.count("*").alias("held"))
    first = counts.where("free = 0").select("shard", F.col("held").alias("linked_before"))
    ranked = numbered(by, ["shard", "free"], ["doc_id", "text_crc32"], "_place", total).join(
        first, "shard", "left").withColumn(
        "_place", F.col("_place") + F.when(F.col("free") == 1, F.coalesce("linked_before", F.lit(0))).otherwise(0))
    wanted = [total // shards + (k < total % shards) for k in range(shards)]
    ranked = cut_lineage(ranked.withColumn(
        "_surplus", (F.col("_place") >= F.element_at(_listed(wanted), F.col("shard") + 1)).cast("int")))
    held = _loads(ranked.where("_surplus = 0").groupBy("shard").agg(F.count("*").alias("n")), shards)
    # the rooms one after the other, and the surplus rows laid along them
    ends = [sum(wanted[:k + 1]) - sum(held[:k + 1]) for k in range(shards)]
    moved = numbered(ranked.where("_surplus = 1"), ["_surplus"], ["doc_id", "text_crc32"], "_turn", total)
    moved = moved.withColumn("_ends", _listed(ends)).withColumn(
        "shard", F.expr("size(filter(_ends, e -> e <= _turn))")).drop("_ends", "_turn")
    kept = ranked.where("_surplus = 0")
    final = cut_lineage(kept.unionByName(moved.select(kept.columns)).drop("_place", "_surplus", "free", "linked_before"))
    return numbered(final, ["shard"], ["doc_id", "text_crc32"], "slot", total)


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, linked``; law ``rows``: counts at most one apart."""
    text = plain_text()
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("text_key"))
    out = balanced_shards(rows, F.col("text_key"), shards)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("grp").isNotNull().alias("linked"))
