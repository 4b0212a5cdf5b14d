"""The byte-level pileup decoder against a plain character loop."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from somaloom.functions import pileup_text as P
from somaloom.operators.pileup import explode_pileup


def plain(text):
    """(allele, strand) of each read-base, one character after another."""
    text, clean, k = text or "ZA", "", 0
    while k < len(text):
        if text[k] == "^" and k + 1 < len(text):
            k += 2
            continue
        if text[k] != "$":
            clean += text[k]
        k += 1
    starts = [k for k in range(len(clean) - 1) if clean[k] in "+-" and clean[k + 1].isdigit()]
    out, k, free = [], 0, False  # free: the last thing read was a base
    while k < len(clean):
        if k in starts:
            stop = min([s for s in starts if s > k] + [len(clean)])
            j = k + 1
            while j < stop and clean[j].isdigit():
                j += 1
            end = min(j + int(clean[k + 1 : j]), stop)
            if free:
                base = out.pop()[2]
                out.append((clean[k:end].upper(), "R" if base == "," else "F", None))
            k, free = end, False
            continue
        c = clean[k]
        allele = "REF" if c in ".," else "DELREFCIGAR" if c == "*" else c.upper()
        out.append((allele, "R" if c == "," or "a" <= c <= "z" else "F", c))
        k, free = k + 1, True
    return [(a, s) for a, s, _ in out]


def decoded(texts):
    row, number, allele, reverse = P.bases(pa.array(texts, pa.string()))
    out = [[] for _ in texts]
    for r, n, a, rev in zip(row.tolist(), number.tolist(), allele.to_pylist(), reverse.tolist()):
        assert n == len(out[r])
        out[r].append((a, "R" if rev else "F"))
    return out


PIECES = st.lists(st.sampled_from(["^", "$", ".", ",", "*", "A", "c", "g", "T", "N", "+2ag", "-1c", "+1", "-12acgtacgtacgt", "+", "-", "^]", "^+", "^^", "^$", "+3a", "3", "+0", "-2"]), max_size=14).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(PIECES | st.none(), max_size=6))
def test_bases(texts):
    assert decoded(texts) == [plain(t) for t in texts]


def test_deep_and_sliced_columns():
    texts = ["^].,+2ag$" * 5000, None, "", "a" * 9, "^", "^^^^.", "$$", "+1a.", ".+1a-1c,"] * 3
    column = pa.array(["x", *texts, "y"], pa.string()).slice(1, len(texts))
    row, number, allele, reverse = P.bases(column)
    assert [(a, "R" if r else "F") for a, r in zip(allele.to_pylist(), reverse.tolist())] == [x for t in texts for x in plain(t)]


COLUMNS = "sample_id string, pos long, read_bases string, bq string, mq string, bp_start string, aln_score string, cigar string, allele string"


def test_rows(spark):
    rows = [("a", 1, "^].$,+2ag*", "!#5", "II", "1,x, 7 ,99999999999", "5,+6,-7", "10M,5S5M,3H7M", "clash"), ("b", 2, None, None, None, None, None, None, None),
            ("c", None, "", "I", "I", "3", "*", "", "clash")]
    got = explode_pileup(spark.createDataFrame(rows, COLUMNS).repartition(2), ["sample_id", "pos"]).collect()
    want = [("a", 1, 0, "REF", "F", 40, 0, 1, 5, "10M", False), ("a", 1, 1, "+2AG", "R", 40, 2, None, 6, "5S5M", True), ("a", 1, 2, "DELREFCIGAR", "F", None, 20, 7, -7, "3H7M", True),
            ("b", 2, 0, "Z", "F", None, None, None, None, None, False), ("b", 2, 1, "A", "F", None, None, None, None, None, False),
            ("c", None, 0, "Z", "F", 40, 40, 3, None, "", False), ("c", None, 1, "A", "F", None, None, None, None, None, False)]
    assert sorted(map(tuple, got), key=lambda r: r[:3:2]) == want
    assert explode_pileup(spark.createDataFrame([], COLUMNS), ["sample_id"]).count() == 0
