"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in an order drawn by hash, are cut into blocks of ``BLOCK_BYTES``. Block k of a
source of weight w is released at slot floor(k / w) and due by slot ceil((k + 1) / w); each slot goes to the
released block that is due first. Weights are held as exact fractions of the numbers given, never rounded, so
after any number of slots every source is within one block of its share of those weights, for as long as all
sources last. When one has run out its slots close up and the others keep their windows.

The driver plans one row a block. A mix has at most ``MAX_BLOCKS`` blocks and one a source: blocks of larger
corpora are larger in proportion, so the plan is bounded at every size. Everything that grows with the corpus
is in Spark: a document's place is found by sums over hash cells of bounded size within groups of cells within
a source, and over blocks, so no source passes through one task. Every document is placed exactly once.

Defined results: a null source is a source of its own; a null text is empty; documents count one byte more
than their text, so empty ones fill blocks too; a source without a given weight, or with less than
``LEAST_SHARE`` of the sum, gets weight 0 and follows after all others; repeated rows each have a place; equal
hashes follow by doc_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, unused

BLOCK_BYTES = 1 << 18
PERIOD = 1000
TEMPERATURE = 0.7
CELL_DOCS = 1024
MAX_BLOCKS = 1 << 18
LEAST_SHARE = 1e-12


def tempered_weights(sizes: dict[str, int], temperature: float = TEMPERATURE) -> dict[str, float]:
    """Weights in proportion to a power of the sources' sizes: large ones give up share to small ones."""
    raw = {s: max(n, 1) ** temperature for s, n in sizes.items()}
    return {s: w / sum(raw.values()) for s, w in raw.items()}


def slot_units(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole slots a period nearest to the weights, for a plan that repeats: largest remainders, one at least."""
    positive = {s: w for s, w in weights.items() if w > 0}
    period = max(period, 10 * len(positive))
    total = sum(positive.values())
    exact = {s: w / total * period for s, w in positive.items()}
    units = {s: max(1, math.floor(x)) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (units[s] - exact[s], s))
    short = period - sum(units.values())
    for k in range(max(0, short)):
        units[by_rest[k % len(by_rest)]] += 1
    while short < 0:  # many tiny sources were raised to one slot
        units[max(units, key=lambda s: (units[s], s))] -= 1
        short += 1
    return units


def plan(shares: dict[str, int | float | Fraction], blocks: dict[str, int] | None = None, first: int = 0) -> dict[str, list[int]]:
    """Slots of each source's blocks: earliest deadline first among released blocks, shares taken as exact.

    ``blocks`` is the number of blocks a source has; by default whole shares, that is one period; slots count from
    ``first``. A source's blocks wait in line: one a source stands in a heap. Slots without a released block stay empty.
    """
    exact = {s: Fraction(w) for s, w in shares.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    parts = {s: int(w * scale) for s, w in exact.items()}
    total = sum(parts.values())
    blocks = parts if blocks is None else blocks

    def window(s: str, k: int) -> tuple[int, tuple[int, int, str, int]]:
        return k * total // parts[s], (-(-(k + 1) * total // parts[s]), -parts[s], s, k)

    slots: dict[str, list[int]] = {s: [] for s in parts}
    waiting = [window(s, 0) for s in parts if blocks[s] > 0]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, str, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            heapq.heappush(ready, heapq.heappop(waiting)[1])
        _, _, source, k = heapq.heappop(ready)
        slots[source].append(first + slot)
        if k + 1 < blocks[source]:
            heapq.heappush(waiting, window(source, k + 1))
        slot += 1
    return slots


def mix_sources(docs: DataFrame, weights: dict[str | None, float] | None = None, block_bytes: int = BLOCK_BYTES, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """One row per document of (doc_id, source, text): doc_id, source, tie, weight, block, slot, position.

    ``weights`` maps sources to target weights; by default they are tempered sizes. ``weight`` is the source's
    share of them, ``position`` the document's place in the mix, from 0; ``tie`` a hash of the text.
    """
    rows = pick(docs, doc_id="long", source="string", text="string").select(
        "doc_id", "source", F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source")).alias("s"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))
    rows = rows.withColumn("draw", F.xxhash64("doc_id", "tie"))
    found = rows.groupBy("s").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()  # a row a source, as the weights have
    sizes = {r["s"]: r["size"] for r in found}
    if not sizes:
        return rows.select("doc_id", "source", "tie", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("slot"), F.lit(0).cast("long").alias("position"))
    given = tempered_weights(sizes) if weights is None else {s: weights.get(s[1:] if s else None, 0.0) for s in sizes}
    if not any(w > 0 for w in given.values()):
        given = dict.fromkeys(sizes, 1.0)
    total = sum(Fraction(w) for w in given.values() if w > 0)
    shares = {s: Fraction(w) / total for s, w in given.items() if w > 0 and Fraction(w) / total >= LEAST_SHARE}
    block_bytes = max(block_bytes, -(-sum(sizes.values()) // max_blocks))
    blocks = {s: (n - 1) // block_bytes + 1 for s, n in sizes.items()}
    slots = plan(shares, {s: blocks[s] for s in shares})
    slots |= plan({s: 1 for s in sizes if s not in shares}, {s: blocks[s] for s in sizes if s not in shares}, 1 + max(own[-1] for own in slots.values()))
    table = pa.table({"s": pa.array([s for s, own in slots.items() for _ in own], pa.string()),
                      "block": pa.array([k for own in slots.values() for k in range(len(own))], pa.int64()),
                      "slot": pa.array([x for own in slots.values() for x in own], pa.int64()),
                      "weight": pa.array([float(shares.get(s, 0)) for s, own in slots.items() for _ in own], pa.float64())})
    planned = docs.sparkSession.createDataFrame(table)  # one row a block

    bits = max(2, math.ceil(math.log2(max(r["n"] for r in found) / CELL_DOCS + 1)))
    rows = rows.withColumn("cell", F.shiftrightunsigned("draw", 64 - bits)).withColumn("part", F.shiftright("cell", bits // 2))
    sums = rows.groupBy("s", "part", "cell").agg(F.sum("size").alias("cell_size"))
    parts = sums.groupBy("s", "part").agg(F.sum("cell_size").alias("part_size"))
    up_to = lambda keys, order: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda column, window: F.coalesce(F.sum(column).over(window), F.lit(0))
    parts = parts.select("s", "part", earlier("part_size", up_to(["s"], ["part"])).alias("parts_before"))
    cells = sums.join(parts, ["s", "part"]).select("s", "cell", (F.col("parts_before") + earlier("cell_size", up_to(["s", "part"], ["cell"]))).alias("before"))
    placed = rows.withColumn("own", earlier("size", up_to(["s", "cell"], ["draw", "doc_id", "size"]))).join(cells, ["s", "cell"])
    placed = placed.withColumn("at", F.col("before") + F.col("own")).withColumn("block", F.expr(f"at div {block_bytes}")).join(planned, ["s", "block"])
    counts = placed.groupBy("slot").agg(F.count("*").alias("n")).select("slot", earlier("n", Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    in_slot = Window.partitionBy("slot").orderBy("at", "draw", "doc_id")
    return (placed.withColumn("rank", F.row_number().over(in_slot)).join(counts, "slot")
            .select("doc_id", "source", "tie", "weight", "block", "slot", (F.col("earlier") + F.col("rank") - 1).cast("long").alias("position")))


def in_mixed_order(docs: DataFrame, weights: dict[str | None, float] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs``, every row kept, its partitions and their rows in the order of the mix.

    Repeated rows stand together, where the first of them is due.
    """
    names = {n: unused(docs, n) for n in ("mix_id", "mix_tie", "mix_position")}
    mixed = mix_sources(docs, weights, block_bytes).groupBy("doc_id", "tie").agg(F.min("position").alias(names["mix_position"]))
    mixed = mixed.select(F.col("doc_id").alias(names["mix_id"]), F.col("tie").alias(names["mix_tie"]), names["mix_position"])
    own_tie = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    joined = docs.join(mixed, docs["doc_id"].cast("long").eqNullSafe(mixed[names["mix_id"]]) & (own_tie == mixed[names["mix_tie"]]))
    n = max(1, docs.rdd.getNumPartitions())
    return joined.repartitionByRange(n, names["mix_position"]).sortWithinPartitions(names["mix_position"]).select(*[docs[c] for c in docs.columns])
