"""License scan, token shards, language model and Lempel-Ziv fingerprints against plain Python."""

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from messy import empty, messy, rows  # noqa: E402

from somaloom.llm import interpolation, lempel_ziv, licenses, tokens, words  # noqa: E402
from somaloom.llm.common import table  # noqa: E402
from somaloom.llm.queries import END_ID, QUERIES, TOKENIZER  # noqa: E402

SF = "/root/testdata/sf0.001"
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}


def test_words_are_those_of_the_pattern():
    texts = [t or "" for _, t, *_ in rows()]
    found = words.split(pa.array(texts))
    cut = [found.data[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends)]
    assert cut == [w for t in texts for w in ALNUM.findall(low(t))]
    assert len(set(zip(cut, found.hashes.tolist()))) == len(set(cut)) == len(set(found.hashes.tolist()))


def test_shingles():
    doc, values = words.shingles(np.array([0, 0, 0, 1, 1, 1, 1, 1, 1]), np.arange(1, 10).astype(np.uint64))
    assert doc.tolist() == [0, 1, 1] and len(set(values.tolist())) == 3


def plain_license(text):
    w = ALNUM.findall(low(text))
    places = sorted((k, label) for phrase, label in licenses.BASE_PHRASES.items() for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split())
    return len(w), len(places), places[0][0] if places else None, max(places)[0] if places else None, ",".join(sorted({label for _, label in places}))


def test_license_base_columns(spark, documents):
    got = QUERIES["op1_license_rules"](spark, SF).collect()
    assert len(got) == len(documents)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_license(documents[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


@pytest.mark.parametrize("text,labels", [
    ("licensed under the apache license, version 2.0.", {"apache-2.0"}),
    ("spdx-license-identifier: gpl-3.0-or-later", {"gpl-3.0"}),
    ("under the gnu general public license,\n * version 3 or later", {"gpl-3.0"}),
    ("this work is under cc by-nc-sa 4.0, code under the 3-clause bsd license", {"cc-by-nc-sa", "bsd-3-clause"}),
    ("see https://www.mozilla.org/en-us/mpl/2.0/", {"mpl-2.0"}),
    ("permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", {"mit"}),
    ("er kam mit licht und general public opinion", set())])
def test_license_rules(text, labels):
    assert {d.label for d in licenses.detect(text)} == labels


def test_license_rules_are_many_and_their_keywords_gate_them():
    assert len(licenses.rules()) > 300
    inner = licenses.Detection("b", "b", 2, 5, 1, 0.5)
    assert licenses.resolve([inner, licenses.Detection("a", "a", 0, 9, 2, 1.0)])[0].rule == "a" and len(licenses.resolve([inner, licenses.Detection("c", "c", 4, 9, 2, 1.0)])) == 2


def without_prefilter(text):
    flat = re.sub(r"[^\S ]", " ", text)
    return licenses.resolve([licenses.Detection(r.name, r.label, m.start(), m.end(), r.priority, r.score) for r in licenses.rules() for m in r.pattern.finditer(flat)])


def some_match(parts, draw, gap):
    """A text that a parsed pattern matches, gaps as given."""
    out = []
    for op, value in parts:
        name = str(op)
        if licenses._gap(op, value):
            out.append(gap)
        elif name == "LITERAL":
            out.append(chr(value))
        elif name == "IN":
            kinds = [v for v in value if str(v[0]) in ("LITERAL", "RANGE")]
            out.append(" " if not kinds else chr(kinds[0][1] if str(kinds[0][0]) == "LITERAL" else kinds[0][1][0]))
        elif name in ("ANY", "NOT_LITERAL"):
            out.append("y")
        elif name == "SUBPATTERN":
            out.append(some_match(value[3], draw, gap))
        elif name == "BRANCH":
            out.append(some_match(draw.choice(value[1]), draw, gap))
        elif name == "MAX_REPEAT":
            out += [some_match(value[2], draw, gap) for _ in range(draw.randint(value[0], min(value[1], value[0] + 1)))]
    return "".join(out)


@pytest.mark.parametrize("gap", [" ", "  ", "\n * ", "\r\n# ", "\u00a0", "' /* "])
def test_license_keywords_skip_no_match(gap):
    draw, matched = random.Random(4), 0
    for rule in licenses.rules():
        for _ in range(12):
            text = some_match(licenses._parser.parse(rule.pattern.pattern, re.S), draw, gap)
            matched += rule.pattern.search(re.sub(r"[^\S ]", " ", text)) is not None
            assert licenses.detect(text) == without_prefilter(text), (rule.name, text)
    assert matched > 5000
    assert all(min(map(len, licenses.keywords(r.pattern))) > 2 for r in licenses.rules())


def test_license_wrapped_notices():
    assert {d.label for d in licenses.detect("the gnu general\n * public license version 3")} == {"gpl-3.0"}
    assert {d.label for d in licenses.detect("permission is hereby granted, free of\n// charge, to any person obtaining a copy of this software and associated documentation files")} == {"mit"}
    assert {d.label for d in licenses.detect("under the expat license")} == {"mit"}


def test_license_awkward(spark):
    got = licenses.scan_licenses(messy(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    assert next(r for r in got if r.doc_id == 13).base_labels == "gpl,mit" and next(r for r in got if r.doc_id == 4).labels == ""
    assert licenses.scan_licenses(empty(spark)).count() == 0


def plain_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, END_ID], "<u4") for x in texts]


def test_token_shards(spark, documents):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op2_token_frames"](spark, SF).collect()}
    start, order = 0, sorted(documents)
    for i, ids in zip(order, plain_ids(documents[i] for i in order)):
        assert got[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_shards_awkward(spark):
    manifest = tokens.write_tokens(messy(spark).select("doc_id", "text"), TOKENIZER, END_ID, shard_bytes=2000)
    assert manifest.count() > 1
    got = tokens.read_tokens(manifest).collect()
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter((i, ids.tobytes()) for (i, *_), ids in zip(rows(), plain_ids(r[1] for r in rows())))
    by_place = sorted(got, key=lambda r: r.start)
    assert [r.start for r in by_place] == np.cumsum([0] + [len(r.ids) // 4 for r in by_place])[:-1].tolist()
    assert [r.doc_id for r in by_place] == sorted((r[0] for r in rows()), key=lambda i: (i is not None, i or 0))
    assert {r.doc_id for r in tokens.read_tokens(manifest, [3, 9]).collect()} == {3, 9}
    assert tokens.token_output(empty(spark), TOKENIZER, END_ID).count() == 0


def test_shard_is_a_zstandard_file_and_checks_its_frames(tmp_path):
    import io

    import zstandard

    shard = tokens.ShardWriter(f"{tmp_path}/a/x.ids.zst", 4)
    for i, ids in ((5, [1, 2, 70000]), (None, [7]), (6, [1])):
        shard.add(i, np.array(ids))
    shard.close()
    raw = open(shard.path, "rb").read()
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read() == np.array([1, 2, 70000, 7, 1], "<u4").tobytes()
    reader = tokens.ShardReader(shard.path, 4)
    assert reader.ids(2) == np.array([1], "<u4").tobytes() and reader.missing.tolist() == [False, True, False]
    with open(shard.path, "r+b") as f:
        f.seek(int(reader.places[1]) - 1)
        f.write(b"\xff")
    with pytest.raises(Exception):
        tokens.ShardReader(shard.path, 4).ids(0)
    assert tokens.ShardReader(shard.path, 4).ids(1) == np.array([7], "<u4").tobytes()


def plain_tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", low(text)) + ["\0end"]


@pytest.mark.parametrize("order,chunk,bucket", [(2, 8 << 20, 4 << 20), (2, 40_000, 30_000), (3, 100_000, 50_000)])
def test_language_model(spark, documents, order, chunk, bucket):
    texts = {i: plain_tokens(t) for i, t in documents.items()}
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    grams = [Counter() for _ in range(order + 1)]
    for i, t in texts.items():
        if not held(i):
            padded = ["\0begin"] * (order - 1) + t
            for o in range(1, order + 1):
                grams[o].update(tuple(padded[k - o + 1 : k + 1]) for k in range(order - 1, len(padded)))
    n, v, n_docs = sum(grams[1].values()), len(grams[1]), sum(not held(i) for i in texts)
    got = interpolation.score_documents(table(spark, SF, "documents"), order, chunk, bucket).collect()
    chunks = interpolation.count_chunks(table(spark, SF, "documents").select("doc_id", "text"), order, chunk, bucket)
    totals = interpolation.Totals(n_docs, n, v)
    cells = interpolation.histogram(chunks, totals, order).sort("cell").collect()
    assert sum(c["n"] for c in cells) == n
    weights = interpolation.learn_weights(cells, order, 1 / (v + 1))
    for r in got:
        t = texts[r.doc_id]
        base = sum(math.log10((grams[1][w,] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(t), sum(grams[1][w,] > 0 for w in t), n, held(r.doc_id)) and math.isclose(base, r.base_score, rel_tol=1e-9)
        padded, score = ["\0begin"] * (order - 1) + t, 0
        for k in range(order - 1, len(padded)):
            p, kind = [1 / (v + 1), grams[1][padded[k],] / n], 0
            for o in range(2, order + 1):
                context = n_docs if k == order - 1 else grams[o - 1][tuple(padded[k - o + 1 : k])]
                p.append(grams[o][tuple(padded[k - o + 1 : k + 1])] / max(context, 1))
                kind = (o - 1) * interpolation.CLASSES + int(math.log2(context)) if context else kind
            score += math.log10(sum(a * b for a, b in zip(weights[kind], p)))
        assert math.isclose(score, r.score, rel_tol=1e-9)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert np.allclose(weights.sum(axis=1), 1)


def test_language_model_awkward(spark):
    got = interpolation.score_documents(messy(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got) and all(r.held_out for r in got if r.doc_id is None)
    assert interpolation.score_documents(empty(spark)).count() == 0
    alone = interpolation.score_documents(messy(spark).filter("doc_id IS NULL")).collect()
    assert len(alone) == 2 and all(r.n_known == 0 and math.isfinite(r.score) for r in alone)


def plain_phrases(data):
    known, start, end = set(), 0, 1
    while end <= len(data):
        if data[start:end] not in known:
            known.add(data[start:end])
            start = end
        end += 1
    return known


def test_phrases_are_those_of_lz78():
    for text in ("", "a", "abababababab", "the cat the hat the bat " * 9, "ñandú" * 7):
        data = text.encode()
        ends = lempel_ziv.Phrases().read(data).ends
        assert {data[a:b] for a, b in zip([0, *ends], ends)} == plain_phrases(data)
        assert lempel_ziv.Phrases().read(data[:5]).copy().read(data[5:]).ends == ends


@pytest.mark.parametrize("bucket_bytes", [4 << 20, 30_000])
def test_fingerprints(spark, documents, bucket_bytes):
    got = {r.doc_id: r for r in lempel_ziv.fingerprint_pairs(table(spark, SF, "documents"), bucket_bytes=bucket_bytes).collect()}
    order = sorted(documents, reverse=True)
    for k, i in enumerate(order):
        text, following = documents[i], documents[order[(k + 1) % len(order)]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        marks = [set(re.findall(".{8}", lempel_ziv.fingerprint(t))) for t in (text, edited, following)]
        near = lambda a, b: sum(x in a and x in b for x in sorted(a | b)[:64]) / min(64, len(a | b)) if a and b else float(a == b)
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), hashlib.sha256(edited.encode()).hexdigest(), lempel_ziv.fingerprint(text), lempel_ziv.fingerprint(edited))
        assert math.isclose(r.near_edited, near(marks[0], marks[1])) and math.isclose(r.near_next, near(marks[0], marks[2]))


def test_fingerprints_awkward(spark):
    for size in (4 << 20, 100_000):
        got = lempel_ziv.fingerprint_pairs(messy(spark), bucket_bytes=size).collect()
        assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
        assert len({r.fingerprint for r in got if r.doc_id in (1, 2)}) == 1 and next(r for r in got if r.doc_id == 4).fingerprint == ""
    assert lempel_ziv.fingerprint_pairs(empty(spark)).count() == 0
    one = lempel_ziv.fingerprint_pairs(messy(spark).filter("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
