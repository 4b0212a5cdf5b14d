"""Prefix tries, token counts and centroid clusters against plain Python."""

import hashlib
import os
import random
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))
from messy import LONG, empty, messy, rows  # noqa: E402

import public_tokenizers  # noqa: E402
from somaloom.llm import prefix_trie as trie  # noqa: E402
from somaloom.llm import subvectors, token_counts  # noqa: E402
from somaloom.llm.common import table  # noqa: E402
from somaloom.llm.queries import ORACLE, QUERIES, TOKENIZER  # noqa: E402

SF = "/root/testdata/sf0.001"


def twin(name):
    con = duckdb.connect()
    for t in ("conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    return sorted(tuple(r[names.index(n)] for n in sorted(names)) for r in found.fetchall()) if names else []


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_subvector_clusters"])
def test_query_equals_its_twin(spark, name):
    got = QUERIES[name](spark, SF)
    assert sorted((tuple(r[c] for c in sorted(got.columns)) for r in got.collect()), key=repr) == sorted(twin(name), key=repr)


# ---- prefix trie ------------------------------------------------------------------------------------


def plain_trie(said, block=100, heads=6):
    turns = defaultdict(list)
    for conv_id, turn, role, text in said:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % heads
        base = c - int(np.fmod(c, block))
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in rebuilt.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def got_trie(df, **how):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in trie.prefix_trie(df, **how).collect())


TALK = "conv_id long, turn long, role string, text string, node string, parent string, base string, member string, depth string, last string, id string"


def talk(spark, said):
    return spark.createDataFrame([(*s, *["x"] * 7) for s in said], TALK).repartition(3)


def test_prefix_trie_awkward(spark):
    said = [(1, 0, "user", "a"), (1, None, None, "first"), (1, 2, "user", None), (1, 2, "bot", "tie"), (1, 2, "bot", "tie"), (None, 0, "user", "lost"),
            (100, 1, "user", "hello"), (100, 2, "bot", "hi \U0001f600"), (101, 1, "user", "hello"), (101, 2, "bot", "hi \U0001f600"), (101, 3, "user", LONG),
            (0, 0, "user", "zero"), (3, 1, "user", "only one"), (-5, 1, "user", "below"), (-5, 2, "bot", ""), (-105, 1, "a", "bc"), (-106, 1, "ab", "c"), (250, 7, "user", "no base")]
    said += [(300 + k, t, "user", f"t{t}") for k in range(7) for t in range(9)]
    assert got_trie(talk(spark, said)) == plain_trie(said)
    assert not got_trie(talk(spark, [(None, 1, "user", "x")])) and not got_trie(spark.createDataFrame([], TALK))


def test_prefix_trie_of_hot_groups(spark):
    """Many copies of one conversation, one first turn for all, many children of one node, one very long conversation."""
    draw = random.Random(1)
    said = [(c, t, "user", f"same {t}") for c in range(100, 400) for t in range(8)]
    said += [(c, t, "user", "same 0" if t == 0 else f"{draw.randrange(3)}") for c in range(400, 600) for t in range(draw.randrange(1, 9))]
    said += [(700, t, "user", f"line {t}") for t in range(1500)]
    said += [(701, t, "user", f"line {t}") for t in range(1499)]
    expected = plain_trie([s for s in said if s[0] < 700])
    assert got_trie(talk(spark, [s for s in said if s[0] < 700])) == expected
    deep = got_trie(talk(spark, said))
    assert len(deep) == len(expected) + 1500 and max(d[1] for d in deep) == 1500
    at = next(d for d in deep if d[1] == 1400 and d[0] == 700)
    assert at[3] == 2 and at[6] == sum(len(f"line {t}") for t in range(1399, 1499))


def test_long_end_lists_are_hashed_in_runs(spark, monkeypatch):
    monkeypatch.setattr(trie, "ENDS", 7)
    ids = list(range(-20, 500, 3))
    ends = spark.createDataFrame([(bytes([i % 2]) * 16, i) for i in ids], "node binary, conv_id long").repartition(5)
    got = {bytes(r.node)[0]: r.ends_sha256 for r in trie.end_digests(ends).collect()}
    assert got == {b: hashlib.sha256(",".join(str(i) for i in ids if i % 2 == b).encode()).hexdigest() for b in (0, 1)}


# ---- token counts -----------------------------------------------------------------------------------


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_counts(spark, name):
    tokenizer = library(name)
    docs = table(spark, SF, "documents")
    want = sorted((r.doc_id, len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    got = token_counts.count_tokens(docs, public_tokenizers.path(name), chunk_bytes=1 << 16).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got) and any(r.over_limit for r in got)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_counts_awkward(spark, name):
    tokenizer = library(name)
    got = token_counts.count_tokens(messy(spark), public_tokenizers.path(name), chunk_bytes=1000).collect()
    want = [(r[0] or -1, len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows()]
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == sorted(want)
    assert token_counts.count_tokens(empty(spark), public_tokenizers.path(name)).count() == 0


def test_unknown_tokenizers_are_refused(spark):
    with pytest.raises(ValueError):
        token_counts.count_tokens(messy(spark), public_tokenizers.path("piece_bpe_32k.model"))


PARTS = st.sampled_from(["don't", "I'LL", "'s", "...", "word", "WORD", "é", "é", "́", " ", "  ", "\n", " ", "\x1c", "\x85", "İ", "Σ", "ſ", "12", "½", "<|endoftext|>", "<|",
                         "|>", ",", "!?", "\U0001f600", "‍", "漢字", "ß", "K", "'", "’s", "_", "\t", "　", "a.b", "x,", "ͅ", "ﬁ"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join) | st.text(max_size=30))
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_of_pre_tokens_add_up(cutters, name, text):
    cutter, whole = cutters[name]
    for blocks in ([text], list(token_counts._blocks(text, 3))):
        assert "".join(blocks) == text
        assert sum(sum(cutter.pieces(cutter.cut(u))) for b in blocks for u in cutter.units(b)) == len(whole.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def cutters():
    return {name: (token_counts.Cutter(public_tokenizers.path(name)), library(name)) for name in ("word_bpe_49k.json", "byte_bpe_50k.json")}


def test_each_distinct_pre_token_is_counted_once(spark):
    words = ["the"] * 500 + [f"w{k % 40}" for k in range(400)] + ["Ġ", token_counts.WHOLE + "<|endoftext|>"]
    given_rows = [(k % 7, k, w) for k, w in enumerate(words)]
    df = spark.createDataFrame(given_rows, "chunk long, place int, word string")
    seen = pa.array(words).unique().to_pylist()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = token_counts.piece_counts(df, TOKENIZER).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    n = dict(zip(seen, token_counts.Cutter(TOKENIZER).pieces(seen)))
    assert sorted((r.chunk, r.place, r.n) for r in got) == sorted((c, p, n[w]) for c, p, w in given_rows)


def test_packed_numbers():
    numbers = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**32 - 1, 2**63, 2**64 - 1, 5], np.uint64)
    assert token_counts._read(token_counts._varied(numbers)).tolist() == numbers.tolist()
    assert not len(token_counts._read(token_counts._varied(np.zeros(0, np.int64))))


# ---- centroid clusters ------------------------------------------------------------------------------


def plain_clusters(vectors, k, rounds, dim):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        for n, some in groups.items():
            centroids[n] = [sum(x) // len(some) for x in zip(*some)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, n in found:
        inertia[n] += d
    return sorted((repr(i), n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, d, n in found)


def got_clusters(df, **how):
    return sorted((repr(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in subvectors.cluster_vectors(df, **how).collect())


VECTORS = "vec_id long, embedding array<double>, cluster string, totals string, h string, place string"


@pytest.mark.parametrize("width,chunk_rows", [(1, 7), (2, 1 << 15), (3, 50), (5, 11)])
def test_clusters(spark, width, chunk_rows):
    draw = np.random.default_rng(3)
    vectors = [(int(k), (draw.normal(size=5) * 2 + 5 * (k % 3)).round(2).tolist()) for k in range(300)]
    vectors += [(1000 + k, [0.5, 0.25, -0.001, 3.0, -7.0]) for k in range(150)]  # a third are one vector
    vectors += [(7, [1.0] * 5), (7, [1.0] * 5), (None, [2.0] * 5), (8, None), (9, []), (10, [1.0] * 4), (11, [1.0] * 6), (12, [1.0, None, 1.0, 1.0, 1.0]),
                (13, [float("nan")] * 5), (14, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (15, [0.0, -float("inf"), 0.0, 0.0, 0.0]), (16, [-0.0] * 5), (17, [1e5] * 5)]
    df = spark.createDataFrame([(*v, *["x"] * 4) for v in vectors], VECTORS).repartition(3)
    assert got_clusters(df, k=8, rounds=4, dim=5, width=width, chunk_rows=chunk_rows) == plain_clusters(vectors, 8, 4, 5)


def test_clusters_of_few_vectors(spark):
    some = [(k, [float(k), 0.0]) for k in range(3)]
    df = spark.createDataFrame([(*v, *["x"] * 4) for v in some], VECTORS)
    assert got_clusters(df, k=8, rounds=2, dim=2) == plain_clusters(some, 8, 2, 2)
    assert not got_clusters(df, dim=5) and not got_clusters(df.limit(0))


def test_components_too_large_are_refused():
    with pytest.raises(OverflowError):
        subvectors.whole(np.array([1e9]))
    assert subvectors.whole(np.array([-0.001, 1.0])).tolist() == [-1, 256]


def test_dictionaries_are_lossless():
    vectors = np.random.default_rng(5).integers(-300, 300, (500, 7))
    chunk = subvectors.Chunk.encode(vectors, 3)
    back = np.concatenate([subs[codes] for _, subs, codes in chunk.parts()], axis=1)
    assert (back[:, :7] == vectors).all() and chunk.entries[0] == len(np.unique(vectors[:, :3], axis=0))
