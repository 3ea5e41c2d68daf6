"""Resharding by minimum-cost flow: new shard sizes with the fewest bytes moved.

The unit of transfer is a block: the rows of one old shard whose texts fall into one of a fixed
number of hash buckets, so equal texts share a block. A block over ``1 / (8 * new shards)`` of all
bytes is split by text hash, and by doc_id only for a text whose own rows exceed that limit; the
other texts of its block stay whole. The block sizes, a table whose length
depends on parameters alone (old shards x buckets, plus at most ``16 * new shards`` parts of split
blocks per level), come to the driver. There a transportation problem from old shard sizes to new
capacities is solved as a minimum-cost flow (staying costs nothing, a moved byte costs one), and
blocks are dealt along the flow, largest first, to the target with the most open quota. The
block-to-shard table, bounded as above, goes back by broadcast; slots are the block's offset plus
the row's rank in its block, so no shard passes through one task.

Defined cases: a null text has size 1 and crc 0. Repeated rows are rows of their own and take
slots of their own, ordered by doc_id (null first), then text hash. Extra columns pass through; one
named like an output is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import folded, kept_names, unfolded

OUT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "old_shard", "moved")


def text_hash(col: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(col), F.lit("")))


def min_cost_flow(supply: list[int], capacity: list[int], stays: dict[int, int]) -> list[dict[int, int]]:
    """Bytes sent from each old shard to each new one: all supply is placed, no capacity exceeded
    (the capacities must cover the supply), moved bytes minimal. ``stays`` maps an old shard to the
    new shard that holds its files; bytes along it cost 0, all others 1.

    Bytes go along shortest paths of the residual network (label-correcting search, as arcs back
    have negative cost); the network has only old + new nodes.
    """
    n, m = len(supply), len(capacity)
    flow = [dict.fromkeys(range(m), 0) for _ in range(n)]
    left, room = list(supply), list(capacity)
    if sum(left) > sum(room):
        raise ValueError("capacities are smaller than the supply")
    cost = [[0 if stays.get(i) == j else 1 for j in range(m)] for i in range(n)]
    while any(left):
        # nodes: old shards 0..n-1, new shards n..n+m-1
        dist = [0 if left[i] else None for i in range(n)] + [None] * m
        back: list[int | None] = [None] * (n + m)
        queue = deque(i for i in range(n) if left[i])
        while queue:
            u = queue.popleft()
            steps = ([(n + j, cost[u][j]) for j in range(m)] if u < n
                     else [(i, -cost[i][u - n]) for i in range(n) if flow[i][u - n]])
            for v, c in steps:
                if dist[v] is None or dist[u] + c < dist[v]:
                    dist[v], back[v] = dist[u] + c, u
                    queue.append(v)
        end = min((n + j for j in range(m) if room[j] and dist[n + j] is not None), key=lambda v: dist[v])
        path = [end]
        while back[path[-1]] is not None:
            path.append(back[path[-1]])
        path.reverse()
        amount = min(left[path[0]], room[end - n])
        for u, v in zip(path, path[1:]):
            if u >= n:
                amount = min(amount, flow[v][u - n])
        for u, v in zip(path, path[1:]):
            if u < n:
                flow[u][v - n] += amount
            else:
                flow[v][u - n] -= amount
        left[path[0]] -= amount
        room[end - n] -= amount
    return flow


def deal(blocks: list[tuple[tuple, int]], old_of: dict[tuple, int], capacity: list[int], n_old: int) -> dict[tuple, int]:
    """The new shard of each block, following the flow from old sizes to capacities."""
    supply = [0] * n_old
    for key, size in blocks:
        supply[old_of[key]] += size
    flow = min_cost_flow(supply, capacity, {i: i for i in range(min(n_old, len(capacity)))})
    to, load = {}, [0] * len(capacity)
    for key, size in sorted(blocks, key=lambda b: (-b[1], b[0])):
        quota = flow[old_of[key]]
        # follow the flow while a quota of this old shard is open; a last piece goes where most room is
        best = max(range(len(capacity)), key=lambda j: (min(quota[j], size), capacity[j] - load[j], -j))
        if quota[best] < size:
            best = max(range(len(capacity)), key=lambda j: (capacity[j] - load[j], -j))
        quota[best] = max(0, quota[best] - size)
        load[best] += size
        to[key] = best
    return to


def reshard(docs: DataFrame, n_old: int = 5, n_new: int = 8, old_shard: Column | None = None,
            capacities: list[float] | None = None, buckets: int = 512, carry: list[str] | None = None) -> DataFrame:
    """``docs`` with size, text_crc32, law, old_shard, shard, slot, grown_shard and moved.

    ``old_shard`` gives each row's present shard (0 to n_old - 1); by default the former layout of
    ``n_old`` shards by text hash. ``capacities`` are the new shards' shares (default equal);
    ``carry`` names the columns to keep (default all).
    """
    spark = docs.sparkSession
    old = F.pmod(text_hash(), F.lit(n_old)).cast("int") if old_shard is None else old_shard.cast("int")
    own = kept_names(docs, OUT) if carry is None else carry
    rows = docs.select(folded(docs, own).alias("own"), old.alias("old_shard"), F.col("doc_id").alias("id"), text_hash().alias("hash"),
                       F.pmod(F.xxhash64(text_hash(), F.lit(7)), F.lit(buckets)).cast("int").alias("bucket"),
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                       (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"))

    sizes = rows.groupBy("old_shard", "bucket").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["b"] for r in sizes)
    limit = max(1, total // (8 * n_new))
    split = {(r["old_shard"], r["bucket"]): r["b"] for r in sizes if r["b"] > limit and r["n"] > 1}
    if split:
        large = F.broadcast(spark.createDataFrame(list(split), "old_shard int, bucket int"))
        # at most 8 * n_new texts have more than the limit
        hot = (rows.join(large, ["old_shard", "bucket"]).groupBy("old_shard", "bucket", "hash")
               .agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).where(F.col("b") > limit).collect())
        rest = dict(split)
        for r in hot:
            rest[r["old_shard"], r["bucket"]] -= r["b"]
        n_parts = {k: max(1, -(-2 * b // limit)) for k, b in rest.items()}
        parts = spark.createDataFrame([(*k, n) for k, n in n_parts.items()], "old_shard int, bucket int, n_parts long")
        texts, at = [], dict(n_parts)
        for r in sorted(hot, key=lambda r: (r["old_shard"], r["bucket"], r["hash"])):
            key, n = (r["old_shard"], r["bucket"]), min(r["n"], -(-2 * r["b"] // limit))
            texts.append((*key, r["hash"], at[key], n))
            at[key] += n
        texts = spark.createDataFrame(texts, "old_shard int, bucket int, hash long, first_part long, n_own long")
        part = (F.when(F.col("n_own").isNotNull(), F.col("first_part") + F.pmod(F.xxhash64("id"), F.col("n_own")))
                .otherwise(F.coalesce(F.pmod(F.xxhash64("hash", F.lit(11)), F.col("n_parts")), F.lit(0))))
        rows = (rows.join(F.broadcast(parts), ["old_shard", "bucket"], "left").join(F.broadcast(texts), ["old_shard", "bucket", "hash"], "left")
                .withColumn("part", part.cast("int")).drop("n_parts", "first_part", "n_own"))
        sizes = rows.groupBy("old_shard", "bucket", "part").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    else:
        rows = rows.withColumn("part", F.lit(0))
    keyed = [((r["old_shard"], r["bucket"], r["part"] if split else 0), r["b"], r["n"]) for r in sizes]
    shares = capacities or [1.0] * n_new
    room = [int(total * s / sum(shares)) for s in shares]
    room[0] += total - sum(room)
    to = deal([(k, b) for k, b, _ in keyed], {k: k[0] for k, _, _ in keyed}, room, n_old)
    offsets, table = [0] * n_new, []
    for k, _, n in sorted(keyed):
        table.append((*k, to[k], offsets[to[k]]))
        offsets[to[k]] += n
    plan = spark.createDataFrame(table, "old_shard int, bucket int, part int, shard int, first long")
    rank = Window.partitionBy("old_shard", "bucket", "part").orderBy("id", "hash")
    return (rows.join(F.broadcast(plan), ["old_shard", "bucket", "part"])
            .select(*unfolded("own", own), "size", "text_crc32", F.lit("bytes").alias("law"), "old_shard", "shard",
                    (F.col("first") + F.row_number().over(rank) - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                    (F.col("old_shard") != F.col("shard")).alias("moved")))


def placement(docs: DataFrame, **options) -> DataFrame:
    """The placement alone (doc_id and digests): no text goes through the ranking shuffle."""
    return reshard(docs, carry=["doc_id"], **options)


def rewrite_affected(resharded: DataFrame, path: str, format: str = "parquet") -> None:
    """Rewrite the affected shards under ``path``, one folder a shard: those that get or lose rows,
    and those that have no folder yet. All other shards keep their files; the folder of a shard that
    lost all its rows goes once the others are written."""
    spark = resharded.sparkSession
    folder = lambda shard: spark._jvm.org.apache.hadoop.fs.Path(f"{path}/shard={shard}")
    files = folder(0).getFileSystem(spark._jsc.hadoopConfiguration())
    filled = {r[0] for r in resharded.select("shard").distinct().collect()}
    moved = {r[0] for r in resharded.where("moved").select(F.explode(F.array("old_shard", "shard"))).distinct().collect()}
    changed = moved & filled | {s for s in filled if not files.exists(folder(s))}
    if changed:
        (resharded.where(F.col("shard").isin(sorted(changed))).repartition("shard", F.floor(F.col("slot") / 1_000_000))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").format(format).save(path))
    for shard in sorted(moved - filled):
        files.delete(folder(shard), True)
