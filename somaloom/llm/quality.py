"""Quality classifier by co-training two views of a document.

The text view sees what the text says and what it is made of: the counts of up to ``TERMS`` words and word pairs that tell good
labelled documents from poor ones, and the shape of bytes, words and lines. The page view sees its metadata (language, source, stated
length). Each is a logistic model. In every round both score all unlabelled documents; those of which a
view is sure, on both sides, become pseudo-labels for the *other* view, which is fitted anew. At the end
each view is calibrated on labelled documents that no fit has seen, and a last logistic step on others again weighs
the two calibrated views (with few labels the same documents serve both); it scores every document, and documents under ``KEEP`` are
rejected. Toxicity is another label and not judged here.

Fits run on bounded samples, chosen by hash: at most ``LABELLED`` labelled rows and, in each round and for
each view, ``PSEUDO`` pseudo-labels; terms are counted over the same labelled rows, in Spark. Everything else (features, the search for sure documents, scores)
covers all rows in Spark.

Defined results: several labels of a document are averaged, and a tie counts as good; null labels do not
count; labels of one class only, or none, keep every document with score 1.0; a null text is empty;
null metadata is a value of its own; repeated rows are scored each; an empty table gives no rows;
other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _give_back, cut_lineage, pick, slices, tidy
from .words import _PLACE, NON_SPACE, mix, raw_bytes, span_hash, split, tally

LABELLED = 20_000
PSEUDO = 2_000
ROUNDS = 3
SURE = 0.95
KEEP = 0.5
PAGE_SLOTS = 64
RIDGE = 1e-3
TERMS = 128  # words and word pairs of the text view
TERM_ROWS = 5  # labelled rows that a term stands in, at least
TERM_ERRORS = 6.0  # standard errors by which its share of good rows differs, at least
FIT_ROWS = 2048

_KINDS = {
    "upper": lambda b: 65 <= b <= 90, "lower": lambda b: 97 <= b <= 122, "digit": lambda b: 48 <= b <= 57, "space": lambda b: b == 32,
    "feed": lambda b: b == 10, "stop": lambda b: b in b".,;:", "bang": lambda b: b in b"!?", "bar": lambda b: b in b"|", "sign": lambda b: b in b"#$%&*@^~+=_\\/<>",
    "other": lambda b: b < 128 and not (chr(b).isalnum() or b in b" \n.,;:!?|#$%&*@^~+=_\\/<>"), "high": lambda b: b >= 128}
_TABLES = {name: np.array([test(b) for b in range(256)]) for name, test in _KINDS.items()}
TEXT_FEATURES = len(_KINDS) + 12


def _share(mask: np.ndarray, group: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    return np.bincount(group, mask, n) / np.maximum(total, 1)


def _repeat_share(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Of each group, the share of values that stood before in it."""
    total = np.bincount(group, minlength=n)
    frame = pd.DataFrame({"g": group, "v": values})
    return _share(frame.duplicated().to_numpy().astype(float), group, n, total)


def text_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and pairs of neighbouring words (A-Z lower-cased) of each text: text, hash, how often."""
    words = split(column)
    pair = words.doc[1:] == words.doc[:-1]
    pairs = mix(words.hashes[:-1] * _PLACE[0] + words.hashes[1:] * _PLACE[1])[pair]
    doc, values = np.concatenate([words.doc, words.doc[1:][pair]]), np.concatenate([words.hashes, pairs])
    order = np.argsort(doc, kind="stable")
    return tally(doc[order], values[order])


def term_features(column: pa.Array, terms: np.ndarray) -> np.ndarray:
    """ln(1 + count) of each of the (sorted) terms in each text."""
    out = np.zeros((len(column), len(terms)))
    if len(terms):
        doc, values, n = text_terms(column)
        at = np.minimum(np.searchsorted(terms, values), len(terms) - 1)
        hit = terms[at] == values
        out[doc[hit], at[hit]] = np.log1p(n[hit])
    return out


def text_features(column: pa.Array) -> np.ndarray:
    """The shape of each text of an Arrow array without nulls, a row each."""
    words, (raw, offsets), n = split(column, NON_SPACE), raw_bytes(column), len(column)
    size, of = np.diff(offsets), np.repeat(np.arange(n), np.diff(offsets))
    out = [_share(t[raw].astype(float), of, n, size) for t in _TABLES.values()]
    count, length = words.counts, words.ends - words.starts
    last, first = raw[words.ends - 1], raw[words.starts]
    ends_odd = _TABLES["sign"][last] | _TABLES["bar"][last]
    inside = np.concatenate([[0], np.cumsum(_TABLES["lower"][raw] | _TABLES["high"][raw])])
    shouted = (inside[words.ends] == inside[words.starts]) & _TABLES["upper"][first] & (length > 1)
    feeds = np.flatnonzero(raw == 10)
    begins = np.unique(np.concatenate([offsets[:-1][size > 0], feeds + 1])) if len(raw) else np.zeros(0, np.int64)
    begins = begins[begins < len(raw)]
    ends = np.append(begins[1:], len(raw)) if len(begins) else begins
    line_of = np.searchsorted(offsets, begins, "right") - 1
    mean = np.bincount(words.doc, length, n) / np.maximum(count, 1)
    out += [np.log1p(size), np.log1p(count), mean, np.sqrt(np.maximum(np.bincount(words.doc, length**2.0, n) / np.maximum(count, 1) - mean**2, 0)),
            _share(ends_odd.astype(float), words.doc, n, count), _share(_TABLES["bang"][last].astype(float), words.doc, n, count),
            _share(shouted.astype(float), words.doc, n, count), _share((length <= 3).astype(float), words.doc, n, count),
            _share((length >= 15).astype(float), words.doc, n, count), _repeat_share(words.doc, words.hashes, n),
            _repeat_share(line_of, span_hash(raw, begins, ends), n), np.log1p(np.bincount(line_of, minlength=n))]
    return np.stack(out, axis=1)


def page_features(lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """Hashed language and source, and the size class of the stated length, a row each."""
    n = len(lang)
    out = np.zeros((n, 2 * PAGE_SLOTS + 24), np.float64)
    for k, column in enumerate((lang, source)):
        hashed = pd.util.hash_array(np.array([("=" + v) if v is not None else "" for v in column.to_pylist()], object), categorize=True)
        out[np.arange(n), k * PAGE_SLOTS + (hashed % np.uint64(PAGE_SLOTS)).astype(int)] = 1
    length = pc.fill_null(n_chars, -1).to_numpy(zero_copy_only=False).astype(float)
    out[np.arange(n), 2 * PAGE_SLOTS + np.where(length < 0, 0, np.clip(1 + np.log2(np.maximum(length, 1)), 1, 23)).astype(int)] = 1
    return out


@dataclass
class Logistic:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the constant

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> Logistic:
        """Ridge logistic regression by Newton steps."""
        centre, scale = x.mean(axis=0, dtype=np.float64), np.maximum(_spread(x), 1e-9)
        size = x.shape[1] + 1
        weights, penalty = np.zeros(size), np.full(size, ridge * len(x))
        penalty[-1] = 1e-6 * len(x)
        for _ in range(30):
            hessian, slope = np.diag(penalty), -penalty * weights
            for start in range(0, len(x), FIT_ROWS):  # a copy of a few rows at a time
                part = x[start : start + FIT_ROWS]
                rows = np.column_stack([np.clip((part - centre) / scale, -10, 10), np.ones(len(part))])
                p = _sigmoid(rows @ weights)
                hessian += (rows * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ rows
                slope += rows.T @ (y[start : start + FIT_ROWS] - p)
            step = np.linalg.solve(hessian, slope)
            weights = weights + step
            if np.abs(step).max() < 1e-8:
                break
        return cls(centre, scale, weights)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -10, 10) @ self.weights[:-1] + self.weights[-1]


def _spread(x: np.ndarray) -> np.ndarray:
    """Standard deviation of each column, in double precision without a copy of all rows."""
    mean, total = x.mean(axis=0, dtype=np.float64), np.zeros(x.shape[1])
    for start in range(0, len(x), FIT_ROWS):
        total += ((x[start : start + FIT_ROWS] - mean) ** 2).sum(axis=0)
    return np.sqrt(total / max(len(x), 1))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    """Two views, each with its calibration, and the weights that join them; ``terms`` are those of the text view."""

    terms: np.ndarray
    views: tuple[Logistic, Logistic]
    calibration: tuple[Logistic, Logistic]
    join: Logistic

    def scores(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sure = [c.logit(v.logit(x)[:, None]) for v, c, x in zip(self.views, self.calibration, (text, page))]
        return _sigmoid(sure[0]), _sigmoid(sure[1]), _sigmoid(self.join.logit(np.column_stack(sure)))


COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}


def text_view(column: pa.Array, terms: np.ndarray) -> np.ndarray:
    """Shape and content of each text."""
    return np.column_stack([text_features(column), term_features(column, terms)])


def _known(labels: DataFrame) -> DataFrame:
    return (pick(labels, doc_id="long", quality="double").filter("doc_id IS NOT NULL AND quality IS NOT NULL")
            .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y")))


def telling_terms(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, terms: int = TERMS) -> np.ndarray:
    """The terms that tell the classes of at most ``labelled`` labelled documents apart best, sorted.

    Each term is counted once a document; what counts is how far its share of good documents is from the overall share, in
    standard errors. Documents and counts stay in Spark; ``terms`` hashes come to the driver.
    """
    known = _known(labels)
    picked = known.orderBy(F.xxhash64("doc_id", F.lit("quality")), "doc_id").limit(labelled)
    total = picked.agg(F.count("*").alias("n"), F.avg("y").alias("p")).first()
    if not total["n"] or not 0 < total["p"] < 1:
        return np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            doc, values, _ = text_terms(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), batch.column(1).take(pa.array(doc))], names=["term", "y"])

    rows = pick(docs, doc_id="long", text="string").join(F.broadcast(picked), "doc_id").select("text", "y")  # at most ``labelled`` ids
    counted = rows.mapInArrow(tidy(run), "term long, y double").groupBy("term").agg(F.count("*").alias("n"), F.sum("y").alias("good")).filter(f"n >= {TERM_ROWS}")
    p = total["p"]
    told = F.abs(F.col("good") - F.col("n") * p) / F.sqrt(F.col("n") * (p * (1 - p)))
    best = counted.filter(told >= TERM_ERRORS).orderBy(told.desc(), "term").limit(terms).select("term").collect()
    return np.sort(np.array([r["term"] for r in best], np.int64).view(np.uint64))


def features(docs: DataFrame, labels: DataFrame, terms: np.ndarray | None = None) -> DataFrame:
    """(doc_id, y, pick, text_view, page_view) of every document; y is null without a label."""
    terms = np.zeros(0, np.uint64) if terms is None else terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            text, page = text_view(batch.column(1), terms), page_features(*(batch.column(k) for k in (2, 3, 4)))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(text), _lists(page)], names=["doc_id", "text_view", "page_view"])

    made = pick(docs, **COLUMNS).mapInArrow(tidy(run), "doc_id long, text_view array<float>, page_view array<float>")
    known = _known(labels)
    return cut_lineage(made.join(known, "doc_id", "left").withColumn("pick", F.xxhash64("doc_id", F.lit("quality"))))


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.astype(np.float32).ravel()), rows.shape[1]).cast(pa.list_(pa.float32()))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.float32)


def _collected(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = rows.toArrow()
    views = [np.concatenate([_matrix(c) for c in found.column(v).chunks]) if found.num_rows else np.zeros((0, 1), np.float32) for v in ("text_view", "page_view")]
    return views[0], views[1], found.column("y").to_numpy().astype(float)


def _sure(table: DataFrame, view: Logistic, column: str, bound: int, turn: int) -> DataFrame:
    """At most ``bound`` unlabelled documents of which a view is sure, in the proportion it finds them."""

    @F.arrow_udf("double")
    def judged(values: pa.Array) -> pa.Array:
        return pa.array(_sigmoid(view.logit(_matrix(values))) if len(values) else np.zeros(0), pa.float64())

    found = table.filter("y IS NULL").withColumn("p", judged(column)).filter(f"p >= {SURE} OR p <= {1 - SURE}")
    return found.withColumn("y", (F.col("p") >= 0.5).cast("double")).orderBy(F.xxhash64("pick", F.lit(turn))).limit(bound).select("text_view", "page_view", "y")


def train(table: DataFrame, labelled: int = LABELLED, pseudo: int = PSEUDO, rounds: int = ROUNDS, terms: np.ndarray | None = None) -> Model | None:
    """Co-train on the rows of ``features`` (made with ``terms``); None without labels of both classes.

    A tenth of the labelled rows calibrates the views, another joins them; neither is fitted by the views.
    """
    sample = table.filter("y IS NOT NULL").orderBy("pick", "doc_id").limit(labelled).select("text_view", "page_view", "y")
    text, page, y = _collected(sample)
    place = np.arange(len(y)) % 10
    rest, joined = place < 8, place == 9
    fold = place == 8
    if not all(0 < part.sum() < len(part) for part in (y[fold], y[joined])):  # few labels: one fold does both
        fold = joined = place >= 8 if len(y) >= 10 else np.arange(len(y)) % 5 == 4
        rest = ~fold
    if not all(0 < part.sum() < len(part) for part in (y[fold], y[rest])):
        return None
    own = [[(text[rest], y[rest])], [(page[rest], y[rest])]]
    fit = lambda rows: Logistic.fit(np.concatenate([x for x, _ in rows]), np.concatenate([t for _, t in rows]))
    views = [fit(rows) for rows in own]
    for turn in range(rounds):
        given = [_collected(_sure(table, view, column, pseudo, turn)) for view, column in zip(views, ("text_view", "page_view"))]
        for giver, taker in ((0, 1), (1, 0)):
            if len(given[giver][2]):
                own[taker].append((given[giver][taker], given[giver][2]))
        views = [fit(rows) for rows in own]
    calibration = [Logistic.fit(v.logit(x[fold])[:, None], y[fold]) for v, x in zip(views, (text, page))]
    sure = [c.logit(v.logit(x[joined])[:, None]) for v, c, x in zip(views, calibration, (text, page))]
    join = Logistic.fit(np.column_stack(sure), y[joined])
    _give_back()
    return Model(np.zeros(0, np.uint64) if terms is None else terms, tuple(views), tuple(calibration), join)


RESULT = "doc_id long, text_score double, page_score double, score double, keep boolean"


def classify(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """One row per document: doc_id, the calibrated score of each view, the joint score, keep."""
    terms = telling_terms(docs, labels)
    table = features(docs, labels, terms)
    model = train(table, terms=terms)
    if model is None:
        one = F.lit(1.0)
        return table.select("doc_id", one.alias("text_score"), one.alias("page_score"), one.alias("score"), F.lit(True).alias("keep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                text, page, joint = model.scores(_matrix(batch.column(1)), _matrix(batch.column(2)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text), pa.array(page), pa.array(joint), pa.array(joint >= keep)], names=["doc_id", "text_score", "page_score", "score", "keep"])

    return table.select("doc_id", "text_view", "page_view").mapInArrow(tidy(run), RESULT)


def quality_of(model: Model, text: Column, lang: Column, source: Column, n_chars: Column) -> Column:
    """The joint score as a column."""

    @F.arrow_udf("double")
    def scored(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        parts = [model.scores(_f32(text_view(b.column(0), model.terms)), page_features(*(b.column(k) for k in (1, 2, 3))))[2]
                 for b in slices([pa.RecordBatch.from_arrays([text, lang, source, n_chars], names=["text", "lang", "source", "n_chars"])], "text")]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return scored(text, lang, source, n_chars)


def _f32(rows: np.ndarray) -> np.ndarray:
    return rows.astype(np.float32).astype(np.float64)


def good_documents(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    terms = telling_terms(docs, labels)
    model = train(features(docs, labels, terms), terms=terms)
    if model is None:
        return docs
    return docs.filter(quality_of(model, *(F.col(f"`{c}`").cast(COLUMNS[c]) for c in ("text", "lang", "source", "n_chars"))) >= keep)
