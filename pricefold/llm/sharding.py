"""Minimum-cost-flow resharding (law ``bytes``).

Rows lie in old shards. Each old shard is cut into blocks (hash buckets of its rows), in proportion to
its bytes; the blocks' sizes are one small aggregation, whatever the corpus holds. A bucket that equal
rows overfill is split by rows. Over the shards a minimum-cost flow with the new capacities says how many
bytes go from which old shard to which new one when the fewest bytes move; whole blocks then carry that
flow. A row's slot comes from the rows of the blocks before its own and its place within the block, so
no task ever holds a whole shard, and a hot old shard is spread over all its blocks.

On files (``lay_out``, ``plan_moves``, ``rewrite``) a block lies in one file with the places of its rows.
Blocks are dealt in the order of their files, so what moves is whole files but for the last one of each
flow. Only files that hold a moving block are rewritten, into the folders of their rows' new shards;
slots are derived from the small table of blocks, so the other files stay valid as they are.

Defined cases: a null text has size 1 and the checksum of no bytes (0); rows with a null or a repeated
id are spread like others; equal rows take slots in any order; an empty table gives an empty result;
columns of the input that clash with the added names are replaced.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

N_SHARDS = 8
#: Bytes of a block to aim at, and the blocks there are at least (they bound how unequal new shards can be)
#: and about at most (the driver holds a row for each).
BLOCK_BYTES, LEAST_BLOCKS, MOST_BLOCKS = 256 << 20, 8192, 1 << 18
#: A bucket of so many rows, and times its share of rows, is split.
HOT_ROWS, HOT_TIMES = 100, 8


def doc_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def home_shard(source: Column, n: int = N_SHARDS) -> Column:
    """The layout that documents come in: all of a source in one shard, so a hot source makes a hot shard."""
    return (F.crc32(F.coalesce(source, F.lit("")).cast("binary")) % n).cast("int")


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Units from each supply to each capacity at the least total cost (successive shortest paths).

    The graph has a node per shard only. Sum of capacities must reach the sum of supplies.
    """
    m, n = len(supply), len(capacity)
    if sum(capacity) < sum(supply):
        raise ValueError("the capacities don't hold all that is supplied")
    source, sink = m + n, m + n + 1
    edges: list[list] = []  # to, room, cost; the reverse edge is next to it
    out: list[list[int]] = [[] for _ in range(m + n + 2)]

    def edge(a, b, room, price):
        out[a].append(len(edges))
        edges.append([b, room, price])
        out[b].append(len(edges))
        edges.append([a, 0, -price])

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
    first = len(edges)
    for i in range(m):
        for j in range(n):
            edge(i, m + j, supply[i], cost[i][j])
    for j, c in enumerate(capacity):
        edge(m + j, sink, c, 0)
    potential = [0] * (m + n + 2)
    left = sum(supply)
    while left:
        dist, via, heap = {source: 0}, {}, [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > dist[a]:
                continue
            for e in out[a]:
                b, room, price = edges[e]
                if room and (to := d + price + potential[a] - potential[b]) < dist.get(b, to + 1):
                    dist[b], via[b] = to, e
                    heapq.heappush(heap, (to, b))
        far = dist[sink]
        potential = [p + min(dist.get(a, far), far) for a, p in enumerate(potential)]
        path, at = [], sink
        while at != source:
            path.append(via[at])
            at = edges[via[at] ^ 1][0]
        send = min(left, *(edges[e][1] for e in path))
        for e in path:
            edges[e][1] -= send
            edges[e ^ 1][1] += send
        left -= send
    return [[edges[first + 2 * (i * n + j) + 1][1] for j in range(n)] for i in range(m)]


def assign_blocks(blocks: list[tuple], olds: list, capacities: list[int],
                  cost: list[list[int]] | None = None) -> list[int]:
    """New shard of each block ``(old shard, bytes)``, following the minimum-cost flow.

    Without ``cost``, a byte that stays in its shard is free and one that moves costs 1. The blocks of an
    old shard go in their order, first to where it is cheapest; small blocks then level what is left.
    """
    n = len(capacities)
    mine: dict = {old: [] for old in olds}
    for b, (old, _) in enumerate(blocks):
        mine[old].append(b)
    cost = cost or [[0 if old == j else 1 for j in range(n)] for old in olds]
    flows = min_cost_flow([sum(blocks[b][1] for b in mine[old]) for old in olds], capacities, cost)
    to, load, rest = [0] * len(blocks), [0] * n, [[] for _ in range(n)]
    for old, flow, price in zip(olds, flows, cost):
        ways = [j for j in sorted(range(n), key=lambda j: (price[j], j)) if flow[j] > 0]
        for b in mine[old]:
            size = blocks[b][1]
            # a block goes on to the next way when less than half of it fits
            while len(ways) > 1 and 2 * flow[ways[0]] < size:
                flow[ways[1]] += flow[ways[0]]
                ways.pop(0)
            j = to[b] = ways[0]
            flow[j] -= size
            load[j] += size
            rest[j].append(b)
    for _ in range(len(blocks)):  # each step makes the fullest shard less full
        over = [load[j] - capacities[j] for j in range(n)]
        high, low = max(range(n), key=lambda j: over[j]), min(range(n), key=lambda j: over[j])
        half = (over[high] - over[low]) // 2
        fits = [b for b in rest[high] if 0 < blocks[b][1] <= half]
        if not fits:
            break
        b = max(fits, key=lambda b: (blocks[b][1], to[b] != blocks[b][0]))
        rest[high].remove(b)
        rest[low].append(b)
        to[b] = low
        load[high] -= blocks[b][1]
        load[low] += blocks[b][1]
    return to


BLOCK = ["_from", "_bucket", "_split"]


def _in_blocks(docs: DataFrame, n_shards: int, old_shard: Column | None, blocks: int | None = None) -> DataFrame:
    """``docs`` with old_shard, size, text_crc32 and their block: _from, _bucket and _split.

    Old shards that are none of the new ones all move, at the same cost to any: for the flow they are one (-1).
    """
    old = home_shard(F.col("source"), n_shards) if old_shard is None else old_shard
    rows = docs.withColumns({"old_shard": F.coalesce(old.cast("int"), F.lit(0)), "size": doc_size(F.col("text")), "text_crc32": text_crc32(F.col("text"))})
    rows = rows.withColumn("_from", F.when(F.col("old_shard").between(0, n_shards - 1), F.col("old_shard")).otherwise(-1))
    held = {k: (size, n) for k, size, n in rows.groupBy("_from").agg(F.sum("size"), F.count(F.lit(1))).collect()}  # n_shards + 1 rows
    total = sum(size for size, _ in held.values())
    blocks = blocks or min(max(total // BLOCK_BYTES, LEAST_BLOCKS), MOST_BLOCKS)
    cut = F.lit(1)
    for k, (size, _) in held.items():
        cut = F.when(F.col("_from") == k, F.lit(max(1, blocks * size // total))).otherwise(cut)
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text_crc32", "size"), cut).cast("int"))
    share = max(1, sum(n for _, n in held.values()) // blocks)
    full = rows.groupBy("_from", "_bucket").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS + HOT_TIMES * share)
    full = common.written(full.select("_from", "_bucket", F.ceil(F.col("_n") / share).cast("int").alias("_parts")), "full")
    if full.isEmpty():
        return rows.withColumn("_split", F.lit(0))
    # equal rows can't be told apart by what they hold: they get a number, and are written with it, so that it lasts
    some = rows.join(F.broadcast(full), ["_from", "_bucket"]).withColumn("_split", F.pmod(F.monotonically_increasing_id(), F.col("_parts")).cast("int"))
    some = common.written(some.drop("_parts"), "split")
    return rows.join(F.broadcast(full.drop("_parts")), ["_from", "_bucket"], "left_anti").withColumn("_split", F.lit(0)).unionByName(some)


def _place() -> Column:
    return F.row_number().over(Window.partitionBy(*BLOCK).orderBy("doc_id", "text_crc32", "size")).cast("long")


def plan_moves(sums: list[tuple], n_shards: int, capacities: list[int] | None) -> list[tuple]:
    """(block, new shard, rows of its blocks before) of each ``(old shard, block, bytes, rows)``, in that order."""
    total = sum(b[2] for b in sums)
    capacities = capacities or [total // n_shards + (j < total % n_shards) for j in range(n_shards)]
    to = assign_blocks([(b[0], b[2]) for b in sums], sorted({b[0] for b in sums}), capacities)
    before, plan = [0] * len(capacities), []
    for b, j in zip(sums, to):
        plan.append((*b[1], j, before[j]))
        before[j] += b[3]
    return plan


PLAN = "_from int, _bucket int, _split int, shard int, _before long"


def reshard(docs: DataFrame, n_shards: int = N_SHARDS, old_shard: Column | None = None,
            capacities: list[int] | None = None, blocks: int | None = None) -> DataFrame:
    """``docs`` with size, text_crc32, old_shard, shard and slot; new shards of near equal bytes.

    ``capacities`` (bytes per new shard, their sum at least all bytes) replaces equal shares.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    rows = _in_blocks(docs, n_shards, old_shard, blocks)
    # a row per block: about MOST_BLOCKS at most
    sums = sorted((r[0], tuple(r[:3]), r[3], r[4]) for r in rows.groupBy(*BLOCK).agg(F.sum("size"), F.count(F.lit(1))).collect())
    moves = F.broadcast(spark.createDataFrame(plan_moves(sums, n_shards, capacities), PLAN))
    return (rows.withColumn("_n", _place()).drop("shard", "slot", "_before").join(moves, BLOCK)
            .withColumn("slot", F.col("_before") + F.col("_n") - 1).drop("_before", "_n", *BLOCK))


def write_shards(assigned: DataFrame, path: str, only_affected: bool = False) -> None:
    """Write shard folders ``shard=K``, rows in slot order within each file.

    With ``only_affected``, ``path`` already holds the old shards: only the folders of shards that lose
    or gain rows are replaced (dynamic partition overwrite); the others keep their files.
    """
    if only_affected:
        moved = assigned.filter(F.col("old_shard") != F.col("shard"))
        touched = moved.select(F.explode(F.array("old_shard", "shard")).alias("shard")).distinct()
        assigned = assigned.join(F.broadcast(touched), "shard", "left_semi")  # a row per shard at most
    writer = assigned.sortWithinPartitions("shard", "slot").write.partitionBy("shard")
    if only_affected:
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    writer.parquet(path)


FILES = "doc_id long, text string, size long, _from int, _bucket int, _split int, place long, written int, shard int"


def lay_out(docs: DataFrame, path: str, n_shards: int = N_SHARDS, old_shard: Column | None = None) -> None:
    """Write ``docs`` (doc_id, text, and source if there is no ``old_shard``) as files of their old shards."""
    common.prepare(docs.sparkSession)
    rows = _in_blocks(docs, n_shards, old_shard).withColumn("place", _place() - 1)
    rows.select("doc_id", "text", "size", *BLOCK, "place", F.lit(0).alias("written"), F.col("old_shard").alias("shard")).write.partitionBy("shard").parquet(path)


def rewrite(spark: SparkSession, path: str, n_shards: int = N_SHARDS, capacities: list[int] | None = None) -> tuple[DataFrame, list[str]]:
    """Move blocks between the shards of ``path`` (by ``lay_out``); only files that hold one of them are rewritten.

    Returns the table of blocks (shard, _before, and ``written``: which writing holds the block) and the names
    of the files that went. Rows of a writing that the table doesn't name are no part of the layout, so it is whole
    at any moment: the new files count when the table is there, and deleting the old ones only frees their space.
    """
    files = spark.read.schema(FILES).parquet(path)
    sums = files.groupBy(F.col("_metadata.file_path").alias("file"), "shard", "written", *BLOCK).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    lies = lambda r: r["shard"] if 0 <= r["shard"] < n_shards else -1
    sums = sorted((lies(r), r["file"], tuple(r[k] for k in BLOCK), r["size"], r["n"], r["shard"], r["written"]) for r in sums.collect())
    plan = plan_moves([(b[0], *b[2:5]) for b in sums], n_shards, capacities)
    went = sorted({b[1] for b, p in zip(sums, plan) if b[5] != p[3]})
    again = 1 + max((b[6] for b in sums), default=0)
    affected = set(went)
    plan = [(*p, again if b[1] in affected else b[6]) for b, p in zip(sums, plan)]
    if went:
        moved = spark.createDataFrame([p for p in plan if p[5] == again], PLAN + ", written int").drop("_before")
        gone = spark.read.schema(FILES).option("basePath", path).parquet(*went).drop("shard", "written")
        gone.join(F.broadcast(moved), BLOCK).write.partitionBy("shard").mode("append").parquet(path)
    moves = common.written(spark.createDataFrame(plan, PLAN + ", written int"), "moves")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in went:
        at = hadoop(name)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, False)
    return moves, went


def read_layout(spark: SparkSession, path: str, moves: DataFrame) -> DataFrame:
    """doc_id, text, shard and slot of a layout with its table of blocks."""
    rows = spark.read.schema(FILES).parquet(path)
    rows = rows.join(F.broadcast(moves.drop("shard")), [*BLOCK, "written"])
    return rows.select("doc_id", "text", "shard", (F.col("_before") + F.col("place")).alias("slot"))


def op3_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 7 of all documents: laid out by source, then only affected files rewritten, and read back."""
    path = common.scratch(spark, "shards")
    lay_out(common.read(spark, sf_dir, "documents").select("doc_id", "text", "source"), path)
    moves, _ = rewrite(spark, path)
    return read_layout(spark, path, moves).select(
        "doc_id", doc_size(F.col("text")).alias("size"), text_crc32(F.col("text")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
