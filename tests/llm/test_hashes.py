"""Word hashes, license resolution and memory helpers."""

import random

import numpy as np
import pyarrow as pa

from somaloom.llm import licenses, words
from somaloom.llm.tokens import WordEncoder
from somaloom.llm.queries import TOKENIZER


def thue_morse(n, swap=False):
    return "".join("ba"[(bin(k).count("1") + swap) % 2] for k in range(n))


def test_words_that_cancel_in_a_polynomial_differ():
    for n in (64, 1024, 2048, 16384, 70000):
        one, two = thue_morse(n), thue_morse(n, True)
        hashes = words.split(pa.array([one, two, one])).hashes
        assert hashes[0] != hashes[1] and hashes[0] == hashes[2]


def test_equal_words_have_equal_hashes_anywhere():
    draw = random.Random(1)
    vocabulary = ["x" * n for n in (1, 2, 5, 300, 20000, 40000)] + [f"w{k}" for k in range(50)] + ["é" * 9000]
    texts = [" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(60))) for _ in range(80)]
    found = words.split(pa.array(texts), words.NON_SPACE)
    seen = {}
    for d, h in zip(found.doc.tolist(), found.hashes.tolist()):
        seen.setdefault(d, []).append(h)
    by_word = {}
    for k, t in enumerate(texts):
        for w, h in zip(t.split(), seen.get(k, [])):
            assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_spans_next_to_each_other_and_empty_ones():
    data = np.frombuffer(b"abcabcabc", np.uint8)
    s = np.array([0, 3, 3, 6])
    got = words.span_hash(data, s, np.array([3, 3, 6, 9]))
    assert got[0] == got[2] == got[3] != got[1]


def test_tokens_of_words_that_cancel_in_a_polynomial():
    from tokenizers import Tokenizer

    texts = [thue_morse(2048), thue_morse(2048, True)]
    ids, cuts = WordEncoder(TOKENIZER)(pa.array(texts))
    whole = Tokenizer.from_file(TOKENIZER)
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_resolution_equals_the_plain_rule_and_is_fast():
    draw = random.Random(5)
    found = [licenses.Detection(f"r{k}", "x", a, a + draw.randrange(1, 40), draw.randrange(4), 1.0) for k, a in enumerate(draw.randrange(300) for _ in range(400))]
    taken = []
    for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.start, d.rule)):
        if not any(t.start <= d.start and d.end <= t.end for t in taken):
            taken.append(d)
    assert licenses.resolve(found) == sorted(taken, key=lambda d: (d.start, d.end))
    assert licenses.resolve([]) == [] and len(licenses.resolve([licenses.Detection("r", "x", k, k + 2, 1, 1.0) for k in range(60_000)])) == 60_000
