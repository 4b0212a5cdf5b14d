"""The prefix trie of rebuilt conversations, by collapsing whole sequences first.

A conversation's rebuilt turns are the first h original turns of the conversation that opens its block
(``conv_id - conv_id % block``), then its own turns after the first h; h is unsigned crc32 of the decimal id modulo ``heads``.
A block is one key of the only shuffle of texts; its partition is streamed in order, so that only the
opening turns of one block are held. What goes on is a narrow row per turn: a chained 128-bit hash that
names the prefix, the hash before, the depth and the length of the text.

1. Conversations of the same last hash are one sequence: its weight, its smallest id, its list of ends.
2. A sequence that some other continues is a proper prefix and falls to an anti-join; the rest are leaves.
3. Prefixes of the distinct sequences are aggregated with weights: members, smallest member, leaves below.
4. Every node belongs to the smallest leaf below it. The nodes of a leaf are the end of its path, so a sum over a
   subtree is the sum of the totals of the leaves below it, less what stands before the node in its own leaf's
   total. Rows stay linear in the turns of distinct sequences, however deep they are.

End lists are written as runs of ids in ranges of (sequence, id); only the hash of a list reads its few runs in
turn. Children find their parent by (parent, salt), so a parent with very many children is many keys.

Defined results: a null conv_id is no conversation and has no node; null roles and texts are empty; a null turn comes first, equal
turns stand in order of role, then text; repeated rows are turns of their own; an empty table has no nodes, not even a root; other
columns are ignored. Texts of any length are hashed whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut_lineage, pick, slices

BLOCK, HEADS = 100, 6
SALTS = 64
ENDS = 1 << 13  # ids of an end list in one row

ROOT = hashlib.blake2b(b"", digest_size=16).digest()
STEPS = "conv_id long, depth long, node binary, parent binary, chars long, last boolean"


def head_turns(conv_id: int, heads: int = HEADS) -> int:
    """How many opening turns conversation ``conv_id`` takes from its block."""
    return zlib.crc32(str(conv_id).encode()) % heads


def next_node(node: bytes, role: str, text: str) -> bytes:
    """The name of the prefix that goes on from ``node`` with one more turn."""
    said = role.encode()
    return hashlib.blake2b(node + len(said).to_bytes(8, "little") + said + text.encode(), digest_size=16).digest()


class _Path:
    """The rebuilt turns of one conversation, met one after another; rows are given out one step late."""

    def __init__(self, conv_id: int):
        self.conv_id, self.depth, self.node, self.waiting = conv_id, 0, ROOT, (conv_id, 0, ROOT, None, 0)

    def turn(self, role: str, text: str) -> tuple:
        before, self.depth, parent = self.waiting, self.depth + 1, self.node
        self.node = next_node(parent, role, text)
        self.waiting = (self.conv_id, self.depth, self.node, parent, len(text))
        return (*before, False)

    def end(self) -> tuple:
        return (*self.waiting, True)


def conversation_steps(turns: DataFrame, block: int = BLOCK, heads: int = HEADS) -> DataFrame:
    """A row per rebuilt conversation and depth, the root included: node, parent, characters of the last turn, whether it ends there."""
    rows = pick(turns, conv_id="long", turn="long", role="string", text="string").filter("conv_id IS NOT NULL").fillna({"role": "", "text": ""})
    rows = rows.withColumn("base", F.col("conv_id") - F.col("conv_id") % block).withColumn("member", F.col("conv_id") != F.col("base"))
    ordered = rows.repartition("base").sortWithinPartitions("base", "member", "conv_id", F.col("turn").asc_nulls_first(), "role", "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, opening, path, seen, own = None, [], None, 0, 0
        names = [c.split()[0] for c in STEPS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
        out: list[tuple] = []

        def batch_of(some: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some) if some else [[]] * 6, kinds)], names=names)

        for batch in slices(batches, "text"):
            for here, conv_id, role, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if path is None or conv_id != path.conv_id:
                    if path is not None:
                        out.append(path.end())
                    if here != base:
                        base, opening = here, []
                    path, seen, own = _Path(conv_id), 0, head_turns(conv_id, heads)
                    if conv_id != base:
                        out.extend(path.turn(*t) for t in opening[:own])
                seen += 1
                if conv_id == base and seen < heads:
                    opening.append((role, text))
                if conv_id == base or seen > own:
                    out.append(path.turn(role, text))
            yield batch_of(out)
            out = []
        if path is not None:
            out.append(path.end())
        yield batch_of(out)

    return ordered.select("base", "conv_id", "role", "text").mapInArrow(walk, STEPS)


def end_digests(ends: DataFrame, ids: str = "conv_id", key: str = "node") -> DataFrame:
    """(node, ends_sha256): sha256 of each key's ids, ascending, comma-joined."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held = None, None, []
        done: list[tuple] = []

        def close():
            if held:
                done.append((node, first, ",".join(map(str, held))))

        for batch in batches:
            for one, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if one != node or len(held) >= ENDS:
                    close()
                    node, first, held = one, conv_id, []
                held.append(conv_id)
            if len(done) >= 1 << 10:
                yield _rows(done)
                done = []
        close()
        yield _rows(done)

    def _rows(some: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([s[k] for s in some], kind) for k, kind in enumerate((pa.binary(), pa.int64(), pa.string()))], names=["node", "first", "run"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for one, run in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if one == node:
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = one, hashlib.sha256()
                state.update(run.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["node", "ends_sha256"])

    listed = ends.select(F.col(key).alias("node"), F.col(ids).alias("id")).repartitionByRange("node", "id").sortWithinPartitions("node", "id")
    packed = listed.mapInArrow(runs, "node binary, first long, run string")
    return packed.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def collapse(steps: DataFrame) -> DataFrame:
    """Distinct whole sequences: smallest member (conv_id), weight, and whether none continues it (leaf)."""
    whole = steps.filter("last").groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"))
    continued = steps.filter("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct()
    leaves = whole.join(continued, "node", "left_anti").select("conv_id", "weight", F.lit(1).alias("leaf"))
    return leaves.unionAll(whole.join(continued, "node", "left_semi").select("conv_id", "weight", F.lit(0).alias("leaf")))


def prefix_trie(turns: DataFrame, block: int = BLOCK, heads: int = HEADS) -> DataFrame:
    """The nodes of the trie of (conv_id, turn, role, text): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    steps = cut_lineage(conversation_steps(turns, block, heads))
    paths = cut_lineage(steps.drop("last").join(collapse(steps), "conv_id"))
    nodes = paths.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("chars").alias("chars"),
        F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.min(F.when(F.col("leaf") == 1, F.col("conv_id"))).alias("owner"))
    own = W.partitionBy("owner").orderBy("depth").rowsBetween(W.unboundedPreceding, -1)
    nodes = cut_lineage(nodes.withColumn("saves", (F.col("n_convs") - 1) * F.col("chars")).withColumn("above", F.coalesce(F.sum("saves").over(own), F.lit(0))))
    totals = nodes.groupBy(F.col("owner").alias("conv_id")).agg(F.sum("saves").alias("total"))
    below = paths.filter("leaf = 1").select("conv_id", "node").join(totals, "conv_id").groupBy("node").agg(F.sum("total").alias("below"))
    salted = nodes.filter("parent IS NOT NULL").groupBy("parent", F.pmod(F.hash("node"), F.lit(SALTS)).alias("salt")).agg(F.count(F.lit(1)).alias("n"))
    children = salted.groupBy(F.col("parent").alias("node")).agg(F.sum("n").alias("n_children"))
    parents = salted.select("parent", "salt").join(nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent")
    none = hashlib.sha256(b"").hexdigest()
    full = (nodes.withColumn("salt", F.pmod(F.hash("node"), F.lit(SALTS)))
            .join(parents, ["parent", "salt"], "left").join(below, "node").join(children, "node", "left").join(end_digests(steps.filter("last")), "node", "left"))
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.col("n_leaves").cast("long").alias("n_leaves"),
        (F.col("below") - F.col("above")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
