"""Repeated paragraphs by MinHash banding.

A paragraph is a line; those of at least ``MIN_WORDS`` words are compared. Equal word sequences are one
item. Each register keeps the smallest of a random permutation of the paragraph's five-word shingles;
bands of few registers give high recall, and colliding paragraphs are verified by the exact Jaccard
index of whole shingle sets (``similar``). Linked paragraphs form components; the first paragraph of a
component (by doc_id, then place) stays, the others are marked for removal.

Passages are found wherever line feeds stand, too: a window is any ``min_words`` words in a row of a text,
and a window that stands earlier in the corpus (by doc_id, then word number) is repeated. Windows are not all
compared: each holds a run of half its words, the leftmost of least hash, that is chosen alike wherever the same
window stands and owns it, so only windows of runs that stand more than once are looked up, and none is missed. The
windows of a run are one row, and rows meet by their run, in cells of bounded size; a run in very many places is dealt
over several cells, whose first copies meet by window. Stretches of repeated windows with first copies in one document
are one repeated run.

Defined results: a null or empty text has no paragraphs; a null ``doc_id`` comes last and never names a
component that has another id; rows of one doc_id are one document, so equal paragraphs at one place of
both are the same first one; an empty table gives no rows; other columns are ignored; lines of any
length are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, pick, slices, tidy
from .similar import BANDS, ROWS, THRESHOLD, band_hashes, link_items
from .words import _BASE, Words, mix, shingles, split, tally, whole_hash

MIN_WORDS = 50


def _min_hash(group: np.ndarray, values: np.ndarray, n_groups: int, size: int) -> np.ndarray:
    """Signatures of the groups' values; groups ascend."""
    out = np.full((n_groups, size), np.iinfo(np.uint64).max, np.uint64)
    if len(group):
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        for k in range(size):
            out[group[first], k] = np.minimum.reduceat(mix(values + np.uint64((k + 1) * int(_BASE) % 2**64)), first)
    return out


def _lines(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line of each word (ascending over all texts); byte places where each line begins and ends."""
    feeds = np.flatnonzero(words.data == 10)
    begins = np.unique(np.concatenate([words.offsets[:-1], feeds + 1]))
    begins = begins[begins < len(words.data)] if len(words.data) else begins[:0]
    ends = np.append(begins[1:], len(words.data))
    return np.searchsorted(begins, words.starts, "right") - 1, begins, ends


def long_lines(words: Words, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lines with enough words: (group of each kept word, its hash, first word of each group, line of each group)."""
    line, begins, _ = _lines(words)
    counts = np.bincount(line, minlength=len(begins))
    kept = counts >= min_words
    number = np.cumsum(kept) - 1
    inside = kept[line]
    first = np.concatenate([[0], np.cumsum(counts)])[:-1][kept]
    return number[line[inside]], words.hashes[inside], first, np.flatnonzero(kept)


PARAGRAPHS = "array<struct<place:int,start:long,end:long,key:long,n:int,bands:array<long>>>"


def paragraphs(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, t, uid, paragraphs) of (doc_id, text): t is the hash of the text, place is the line's number, start and end code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("place", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("bands", pa.list_(pa.int64()))]
        for batch in slices(batches, "text"):
            words = split(batch.column(1))
            group, hashes, first, lines = long_lines(words, min_words)
            _, begins, ends = _lines(words)
            of, values, _ = tally(*shingles(group, hashes))
            bands = band_hashes(_min_hash(of, values, len(lines), ROWS * BANDS)).view(np.int64)
            points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
            doc = np.searchsorted(words.offsets, begins[lines], "right") - 1
            origin = points[words.offsets[:-1]][doc]
            place = lines - np.searchsorted(begins, words.offsets[:-1], "left")[doc]
            start, end = points[begins[lines]] - origin, points[ends[lines]] - origin
            held = pa.StructArray.from_arrays([
                pa.array(place.astype(np.int32)), pa.array(start), pa.array(end), pa.array(whole_hash(group, hashes, len(lines)).view(np.int64)),
                pa.array(np.bincount(of, minlength=len(lines)).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(np.arange(len(lines) + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))], fields=[pa.field(*f) for f in fields])
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.ListArray.from_arrays(pa.array(cuts), held)], names=["doc_id", "t", "paragraphs"])

    found = _named(docs).mapInArrow(tidy(run), f"doc_id long, t long, paragraphs {PARAGRAPHS}")
    return cut_lineage(found.withColumn("uid", F.monotonically_increasing_id()))


def paragraph_sets(docs: DataFrame, keys: DataFrame, min_words: int) -> DataFrame:
    """(key, shingles) of the paragraphs with those keys; ``docs`` are (doc_id, text) that hold them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = split(batch.column(1))
            group, hashes, first, lines = long_lines(words, min_words)
            of, values, _ = tally(*shingles(group, hashes))
            cuts = np.searchsorted(of, np.arange(len(lines) + 1))
            yield pa.RecordBatch.from_arrays([pa.array(whole_hash(group, hashes, len(lines)).view(np.int64)),
                                              pa.array([values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())], names=["key", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "key long, shingles binary").join(keys, "key", "left_semi").dropDuplicates(["key"])


def _named(docs: DataFrame) -> DataFrame:
    """(doc_id, text, t): t is the hash of the text."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("t"))


def _slide(values: np.ndarray, size: int, join) -> np.ndarray:
    """``join`` over every ``size`` values in a row; fewer values give none."""
    if len(values) < size:
        return values[:0]
    width = 1
    while width < size:
        step = min(width, size - width)
        values, width = join(values[:-step], values[step:]), width + step
    return values


def _chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _BASE + b)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For every ``size`` words in a row: their hash, and whether they stand in one text."""
    last = max(len(words.doc) - size + 1, 0)
    return _slide(words.hashes, size, _chain), words.doc[:last] == words.doc[len(words.doc) - last :]


def anchors(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the runs of half a window that have the least hash in a window of a text."""
    run = (size + 1) // 2
    span = size - run + 1
    grams = _slide(words.hashes, run, _chain) | np.uint64(1)
    least = np.where(windows(words, size)[1], _slide(grams, span, np.minimum), np.uint64(0))
    if not len(least):
        return np.zeros(0, np.int64), grams[:0]
    none = np.zeros(span - 1, np.uint64)
    at = np.flatnonzero(_slide(np.concatenate([none, least, none]), span, np.maximum) == grams)
    return at, grams[at]


def owners(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, owner) of the windows that stand in one text: the owner is the first word of the leftmost of their anchors of least hash.

    Owners never fall along a text, so an owner's windows stand in a row, and equal windows have equal anchors at equal distances.
    """
    run = (size + 1) // 2
    grams = _slide(words.hashes, run, _chain) | np.uint64(1)
    begin = np.flatnonzero(windows(words, size)[1])
    least = _slide(np.arange(len(grams)), size - run + 1, lambda a, b: np.where(grams[b] < grams[a], b, a))
    return begin, least[begin]


def _text_anchors(docs: DataFrame, size: int) -> DataFrame:
    """(t, first, copies, anchors) of the distinct texts: first is the smallest doc_id, nulls last; copies counts the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = split(batch.column(1))
            at, hashes = anchors(words, size)
            cuts = np.searchsorted(words.doc[at], np.arange(batch.num_rows + 1)).astype(np.int32)
            held = pa.StructArray.from_arrays([pa.array((at - words.firsts[words.doc[at]]).astype(np.int32)), pa.array(hashes.view(np.int64))], names=["place", "anchor"])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.ListArray.from_arrays(pa.array(cuts), held)], names=["doc_id", "t", "anchors"])

    found = _named(docs).mapInArrow(tidy(run), "doc_id long, t long, anchors array<struct<place:int,anchor:long>>").filter("size(anchors) > 0")
    return cut_lineage(found.groupBy("t").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.first("anchors").alias("anchors")))


OWNED = "cell long, hot boolean, t long, first long, copies long, place int, windows array<long>, starts array<int>, ends array<int>"


def _owned_windows(docs: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """Rows of OWNED for the places (place, cell, hot) of the texts (t, first, copies, places): the windows owned by the anchor there.

    place is the first window's; hashes and code points of an anchor's windows are lists in one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = split(batch.column(0))
            hashes, _ = windows(words, size)
            begin, owner = owners(words, size)
            listed = batch.column(4)
            of = np.repeat(np.arange(batch.num_rows), listed.value_lengths().to_numpy(zero_copy_only=False))
            flat = listed.flatten()
            at = flat.field("place").to_numpy(zero_copy_only=False) + words.firsts[of]
            order = np.argsort(at, kind="stable")
            spot = np.searchsorted(at[order], owner)
            known = np.zeros(len(owner), bool)
            known[spot < len(at)] = at[order][spot[spot < len(at)]] == owner[spot < len(at)]
            begin, owner, spot = begin[known], owner[known], order[spot[known]]
            cuts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else owner[:0]
            points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
            doc = words.doc[begin]
            origin = points[words.offsets[:-1]][doc]
            head, own = pa.array(spot[cuts]), pa.array(doc[cuts])
            ranges = pa.array(np.append(cuts, len(begin)).astype(np.int32))
            lists = [hashes[begin].view(np.int64), (points[words.starts[begin]] - origin).astype(np.int32), (points[words.ends[begin + size - 1]] - origin).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([
                flat.field("cell").take(head), flat.field("hot").take(head), *[batch.column(k).take(own) for k in (1, 2, 3)],
                pa.array((begin - words.firsts[doc])[cuts].astype(np.int32)), *[pa.ListArray.from_arrays(ranges, pa.array(x)) for x in lists]],
                names=["cell", "hot", "t", "first", "copies", "place", "windows", "starts", "ends"])

    own = _named(docs).alias("d").join(places.alias("p"), (F.col("d.t") == F.col("p.t")) & F.col("d.doc_id").eqNullSafe(F.col("p.first")))
    return own.select("d.text", "p.t", "p.first", "p.copies", "p.places").mapInArrow(tidy(run), OWNED)


def _flat_windows(group: pa.Table) -> dict[str, np.ndarray]:
    """The windows of OWNED rows: row, window, place, start, end, and unnamed and first of their text."""
    group = group.combine_chunks()
    lists = [group.column(c).combine_chunks() if group.num_rows else group.column(c).type.value_type for c in ("windows", "starts", "ends")]
    if not group.num_rows:
        lists = [pa.array([], pa.list_(kind)) for kind in lists]
    lengths = lists[0].value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(group.num_rows), lengths)
    within = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    window, start, end = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
    first = group.column("first")
    return {"row": row, "window": window, "start": start, "end": end, "place": group.column("place").to_numpy()[row] + within,
            "unnamed": first.is_null().to_numpy()[row], "first": first.fill_null(0).to_numpy()[row]}


def _least(flat: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The first copy of each distinct window, by window: unnamed, first and place."""
    order = np.lexsort((flat["place"], flat["first"], flat["unnamed"], flat["window"]))
    window = flat["window"][order]
    order = order[np.flatnonzero(np.append(True, window[1:] != window[:-1]))] if len(order) else order
    return {c: flat[c][order] for c in ("window", "unnamed", "first", "place")}


STRETCHES = "t long, own boolean, unnamed boolean, first_doc long, low int, high int, start long, end long"


def _stretches(group: pa.Table, flat: dict[str, np.ndarray], heads: dict[str, np.ndarray]) -> pa.Table:
    """Rows of STRETCHES: repeated windows in a row with first copies in one document.

    In the document that holds the text first (own) all but first copies are repeated; in other documents of the text, all.
    """
    spot = np.searchsorted(heads["window"], flat["window"])
    unnamed, first_doc = heads["unnamed"][spot], heads["first"][spot]
    is_head = (flat["unnamed"] == unnamed) & (flat["first"] == first_doc) & (flat["place"] == heads["place"][spot])
    t, copied = group.column("t").to_numpy(), group.column("copies").to_numpy() > 1
    parts = []
    for own, kept in ((True, ~is_head), (False, copied[flat["row"]])):
        at = np.flatnonzero(kept)
        row, place, named = flat["row"][at], flat["place"][at], (unnamed[at], first_doc[at])
        new = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1) | (named[0][1:] != named[0][:-1]) | (named[1][1:] != named[1][:-1])
        low = np.flatnonzero(np.append(True, new)) if len(at) else at
        high = np.append(low[1:], len(at))[: len(low)] - 1
        none = named[0][low]
        parts.append(pa.table({
            "t": t[row[low]], "own": np.full(len(low), own), "unnamed": none, "first_doc": pa.array(named[1][low], pa.int64(), mask=none),
            "low": place[low].astype(np.int32), "high": place[high].astype(np.int32),
            "start": flat["start"][at[low]].astype(np.int64), "end": flat["end"][at[high]].astype(np.int64)}))
    return pa.concat_tables(parts)


CELL_ROWS = 1 << 14  # anchors whose windows one task compares at a time, on average


def _stretches_in_cell(group: pa.Table) -> pa.Table:
    flat = _flat_windows(group)
    return _stretches(group, flat, _least(flat))


def _heads_in_cell(group: pa.Table) -> pa.Table:
    heads = _least(_flat_windows(group))
    return pa.table({"cell": pa.array([group.column("cell")[0].as_py()] * len(heads["window"]), pa.int64()), **heads, "place": heads["place"].astype(np.int32)})


def _stretches_by_heads(group: pa.Table, heads: pa.Table) -> pa.Table:
    order = np.argsort(heads.column("window").to_numpy())
    known = {c: heads.column(c).to_numpy(zero_copy_only=False)[order] for c in ("window", "unnamed", "first", "place")}
    return _stretches(group, _flat_windows(group), known)


def _all_stretches(owned: DataFrame, hot: bool) -> DataFrame:
    """STRETCHES of all OWNED rows. Windows meet in the cell of their anchor; a hot anchor has several cells, whose first copies meet by window."""
    found = owned.filter("NOT hot").groupBy("cell").applyInArrow(_stretches_in_cell, STRETCHES)
    if not hot:
        return found
    dealt = owned.filter("hot")
    local = cut_lineage(dealt.groupBy("cell").applyInArrow(_heads_in_cell, "cell long, window long, unnamed boolean, first long, place int"))
    least = local.groupBy("window").agg(F.min(F.struct("unnamed", "first", "place")).alias("head"))
    heads = local.select("cell", "window").join(least, "window").select("cell", "window", "head.*")
    return found.unionByName(dealt.groupBy("cell").cogroup(heads.groupBy("cell")).applyInArrow(_stretches_by_heads, STRETCHES))


def repeated_runs(docs: DataFrame, size: int) -> DataFrame:
    """(t, own, runs, first) of (doc_id, text): repeated runs of a text, in the document that holds it first (own) and in its others."""
    texts = _text_anchors(docs, size)
    flat = texts.select("t", "copies", F.explode("anchors").alias("a")).select("t", "copies", "a.*")
    shared = cut_lineage(flat.groupBy("anchor").agg(F.sum("copies").alias("c"), F.count("*").alias("n")).filter("c > 1").select("anchor", "n"))
    total, top = shared.agg(F.sum("n"), F.max("n")).first()
    cells = (total or 0) // CELL_ROWS + 1
    is_hot = F.col("n") > CELL_ROWS
    salted = F.xxhash64("anchor", F.pmod(F.xxhash64("t", "place"), F.floor(F.col("n") / CELL_ROWS) + 1))
    cell = F.when(is_hot, salted).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(cells)))
    places = flat.select("t", "anchor", "place").join(shared, "anchor").groupBy("t").agg(F.collect_list(F.struct("place", cell.alias("cell"), is_hot.alias("hot"))).alias("places"))
    owned = cut_lineage(_owned_windows(docs, places.join(texts.select("t", "first", "copies"), "t"), size))
    each = _all_stretches(owned, (top or 0) > CELL_ROWS)
    whose = Window.partitionBy("t", "own", "unnamed", "first_doc").orderBy("low")
    joined = each.withColumn("stretch", F.sum((F.col("low") > F.lag("high", 1, -2).over(whose) + 1).cast("int")).over(whose.rowsBetween(Window.unboundedPreceding, 0)))
    runs = joined.groupBy("t", "own", "unnamed", "first_doc", "stretch").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    listed = runs.groupBy("t", "own").agg(F.array_sort(F.collect_list(F.struct("start", "end", "first_doc"))).alias("runs"))
    return listed.join(texts.select("t", "first"), "t")


REMOVED = "start long, end long, first_doc long"


def repeated_paragraphs(docs: DataFrame, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document of (doc_id, text): doc_id, n_paragraphs, n_repeated, n_removed, removed, repeated_in, n_runs, runs.

    n_repeated counts paragraphs of which the corpus holds another; removed lists those that are not the
    first: code points start (inclusive) and end, and the document that keeps the first; repeated_in
    lists the documents whose first paragraph the document's repeated ones belong to. runs lists the
    repeated runs of at least ``min_words`` equal words, whatever the lines: code points, and the document
    that holds the first copies of their windows.
    """
    docs = pick(docs, doc_id="long", text="string")
    held = paragraphs(docs, min_words)
    flat = held.select("uid", "doc_id", F.explode("paragraphs").alias("p")).select("uid", "doc_id", "p.*")
    at = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "place")
    heads = flat.groupBy("key").agg(F.min(at).alias("head"), F.countDistinct("doc_id", "place").alias("copies"))
    items = flat.groupBy("key").agg(F.first("n").alias("n"), F.first("bands").alias("bands"))

    def sets_of(keys: DataFrame) -> DataFrame:
        where = heads.join(keys, "key").select(F.col("head.doc_id").alias("doc_id")).distinct()
        return paragraph_sets(docs.join(where, "doc_id", "left_semi"), keys, min_words)

    found = link_items(items.join(heads.filter("NOT head.unnamed").select("key"), "key", "left_semi"), sets_of, threshold)
    if found is None:
        classes = heads.select("key", "head", F.col("copies").alias("members"))
    else:
        labelled = heads.join(found[1], "key", "left").withColumn("label", F.coalesce("label", "key"))
        tops = labelled.groupBy("label").agg(F.min("head").alias("top"), F.sum("copies").alias("members"))
        classes = labelled.join(tops, "label").select("key", F.col("top").alias("head"), "members")
    classes = classes.filter("members > 1").select("key", F.col("head.doc_id").alias("first_doc"), F.col("head.place").alias("first_place"))
    marked = flat.select("uid", "doc_id", "place", "start", "end", "key").join(classes, "key")
    gone = ~(F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("place") == F.col("first_place")))
    by_doc = marked.groupBy("uid").agg(
        F.count("*").alias("n_repeated"), F.array_sort(F.collect_list(F.when(gone, F.struct("start", "end", "first_doc")))).alias("removed"),
        F.array_sort(F.collect_set("first_doc")).alias("repeated_in"))
    none = F.expr(f"cast(array() as array<struct<{REMOVED.replace(' long', ':long')}>>)")
    runs = repeated_runs(docs, min_words)
    by_text = runs.groupBy("t", "first").agg(*[F.first(F.when(c, F.col("runs")), ignorenulls=True).alias(n) for c, n in ((F.col("own"), "own_runs"), (~F.col("own"), "copy_runs"))])
    runs = F.coalesce(F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.col("own_runs")).otherwise(F.col("copy_runs")), none)
    return (held.select("uid", "doc_id", "t", F.size("paragraphs").alias("n")).join(by_doc, "uid", "left").join(by_text, "t", "left").withColumn("runs", runs)
            .select("doc_id", F.col("n").cast("long").alias("n_paragraphs"), F.coalesce("n_repeated", F.lit(0)).cast("long").alias("n_repeated"),
                    F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce("removed", none).alias("removed"),
                    F.coalesce("repeated_in", F.expr("cast(array() as array<long>)")).alias("repeated_in"),
                    F.size("runs").cast("long").alias("n_runs"), "runs"))
