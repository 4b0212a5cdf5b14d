"""Packed pileup strings to one row per read-base, on the bytes of whole Arrow columns.

The base strings of many rows are one byte buffer. A byte's part in it - read-start mark, its
quality, read-end mark, indel text, base - follows from comparisons with its neighbours, run lengths and prefix sums,
so that all rows are decoded by a fixed number of array operations, whatever their depth.

Rules: ``^`` and the byte behind it open a read; ``$`` closes one; ``+n`` / ``-n`` and n bytes are an
indel that replaces the allele of the base in front of it; ``.`` and ``,`` are the reference, ``*`` a deleted
base; ``,`` and small letters are on the reverse strand, but a base in front of an indel counts by ``,`` alone. An
indel mark without a number is a base; a length beyond the string, or beyond the next indel, ends there; an indel
behind no base is passed over. A null or empty string stands for the bases ``ZA``. Lists shorter than the bases
give NULL for the rest, longer ones are cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

CARET, DOLLAR, PLUS, MINUS, STAR, DOT, COMMA = (ord(c) for c in "^$+-*.,")
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[97:123] -= 32
_SMALL = (np.arange(256) >= 97) & (np.arange(256) <= 122)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_SINGLE = pa.array(["REF" if b in (DOT, COMMA) else "DELREFCIGAR" if b == STAR else bytes([_UPPER[b]]).decode("latin-1") for b in range(256)], pa.string())


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offset of each row (one more than there are rows); nulls are empty."""
    column = pc.fill_null(column.cast(pa.string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _ahead(values: np.ndarray, fill) -> np.ndarray:
    """Each place's next value."""
    return np.append(values[1:], fill).astype(values.dtype) if len(values) else values


def _pack(keep: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets after only the bytes of ``keep`` are left."""
    return np.concatenate([[0], np.cumsum(keep)])[offsets]


def _without_marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings without read-start marks, their qualities and read-end marks."""
    n = len(data)
    caret, first, last = data == CARET, np.zeros(n, bool), np.zeros(n, bool)
    some = offsets[1:] > offsets[:-1]
    first[offsets[:-1][some]] = True
    last[offsets[1:][some] - 1] = True
    # in a run of carets every other one, from its first, is a mark, the rest are qualities of marks
    opens = caret & (first | ~np.concatenate([[False], caret[:-1]]))
    place = np.arange(n)
    since = place - np.maximum.accumulate(np.where(opens, place, 0)) if n else place
    mark = caret & (since % 2 == 0) & ~last
    dead = mark | np.concatenate([[False], mark[:-1]])
    keep = ~(dead | (data == DOLLAR))
    return data[keep], _pack(keep, offsets)


def _indels(data: np.ndarray, row: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the indel texts; ``ends`` is each row's end."""
    digit = _DIGIT[data]
    follows = _ahead(digit, False) & (_ahead(row, -1) == row)
    starts = np.flatnonzero(((data == PLUS) | (data == MINUS)) & follows)
    if not len(starts):
        return starts, starts
    stop = np.minimum(ends[row[starts]], np.append(starts[1:], len(data)))
    others = np.append(np.flatnonzero(~digit), len(data))
    number_end = np.minimum(others[np.searchsorted(others, starts + 1)], stop)
    length = np.zeros(len(starts), np.int64)
    for k in range(int((number_end - starts - 1).max())):
        at = starts + 1 + k
        inside = at < number_end
        length[inside] = np.minimum(length[inside] * 10 + data[at[inside]] - 48, 1 << 40)
    return starts, np.minimum(number_end + length, stop)


def bases(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Of all read-bases: row, number within the row, allele, and whether the strand is reverse."""
    text = pc.if_else(pc.equal(pc.binary_length(pc.fill_null(column, "")), 0), "ZA", pc.fill_null(column, ""))
    data, offsets = _without_marks(*buffers(text))
    row = np.repeat(np.arange(len(column)), np.diff(offsets))
    starts, ends = _indels(data, row, offsets[1:])
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    base = np.cumsum(edge[:-1]) == 0
    ahead = starts - 1
    marked = (ahead >= 0) & (starts > offsets[row[starts]]) & base[ahead]
    code = data.astype(np.int64)
    code[ahead[marked]] = 256 + np.flatnonzero(marked)
    at = np.flatnonzero(base)
    code, row = code[at], row[at]
    reverse = (data[at] == COMMA) | (_SMALL[data[at]] & (code < 256))
    sizes = ends - starts
    gathered = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum()) if len(sizes) else np.zeros(0, np.int64)
    texts = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                                                             pa.py_buffer(np.ascontiguousarray(_UPPER[data[gathered]]))])
    number = np.arange(len(row)) - np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(column)))])[row]
    return row, number, pa.concat_arrays([_SINGLE, texts]).take(pa.array(code)), reverse


def _spots(offsets: np.ndarray, row: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where entry ``number`` of a row stands, and whether the row has it."""
    at = offsets[row] + number
    return at, at < offsets[row + 1]


def qualities(column: pa.Array, row: np.ndarray, number: np.ndarray) -> pa.Array:
    """Qualities (byte - 33) of the read-bases."""
    data, offsets = buffers(column)
    at, has = _spots(offsets, row, number)
    out = np.zeros(len(row), np.int32)
    out[has] = data[at[has]].astype(np.int32) - 33
    return pa.array(out, mask=~has)


def _entries(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    lists = pc.split_pattern(pc.fill_null(column.cast(pa.string()), ""), ",")
    return lists.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])


def numbers(column: pa.Array, row: np.ndarray, number: np.ndarray) -> pa.Array:
    """Entries of comma lists as ints; an unreadable entry is NULL."""
    texts, offsets = _entries(column)
    texts = pc.utf8_trim_whitespace(texts)
    good = pc.match_substring_regex(texts, "^[+-]?[0-9]{1,12}$")
    values = pc.if_else(good, pc.utf8_ltrim(texts, "+"), None).cast(pa.int64())
    fits = pc.and_(pc.less_equal(values, (1 << 31) - 1), pc.greater_equal(values, -(1 << 31)))
    values = pc.if_else(fits, values, None).cast(pa.int32())
    at, has = _spots(offsets, row, number)
    return values.take(pa.array(at, mask=~has))


def strings(column: pa.Array, row: np.ndarray, number: np.ndarray) -> pa.Array:
    """Entries of comma lists."""
    texts, offsets = _entries(column)
    at, has = _spots(offsets, row, number)
    return texts.take(pa.array(at, mask=~has | ~np.asarray(column.is_valid())[row]))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``limit`` bytes of ``column``; a longer row is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.concatenate([[0], np.cumsum(sizes)[:-1]]) // limit
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
    for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if stop > start:
            yield batch.slice(start, stop - start)


def decode(batch: pa.RecordBatch, keys: list[str]) -> pa.RecordBatch:
    """One row per read-base of a batch of packed rows."""
    column = batch.column
    row, number, allele, reverse = bases(column("read_bases"))
    cigar = strings(column("cigar"), row, number)
    take = pa.array(row)
    parts = {k: column(k).take(take) for k in keys} | {
        "read_no": pa.array(number, pa.int32()), "allele": allele, "strand": pc.if_else(pa.array(reverse), "R", "F"),
        "mq": qualities(column("mq"), row, number), "bq": qualities(column("bq"), row, number),
        "bp_start": numbers(column("bp_start"), row, number), "aln_score": numbers(column("aln_score"), row, number),
        "cigar": cigar, "clipped": pc.fill_null(pc.match_substring_regex(cigar, "[HS]"), False)}
    return pa.RecordBatch.from_arrays(list(parts.values()), names=list(parts))
