"""Mutation spectra and signature activities: merging, coverage, comparison, refit."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from somaloom.functions.ranks import average_rank
from somaloom.functions.variants import is_snv_strict, mutation_end, mutation_type

SUBSTITUTIONS = ("C>A", "C>G", "C>T", "T>A", "T>C", "T>G")


def variant_table(called: DataFrame, project: str, genome: str) -> DataFrame:
    """Signature-input rows of the called cells (``variant_id`` parts must be columns)."""
    rows = called.filter(F.col("call") == 1)
    return rows.select(
        F.lit(project).alias("project"), "sample_id", F.lit(".").alias("id"), F.lit(genome).alias("genome"), mutation_type().alias("mut_type"),
        "chrom", F.col("pos").alias("pos_start"), mutation_end().alias("pos_end"), "ref", "alt", F.lit("SOMATIC").alias("type"))


def substitution_class(ref="ref", alt="alt") -> Column:
    """Base change folded to the pyrimidine strand (``C>A`` … ``T>G``)."""
    folded = F.col(ref).isin("A", "G")
    side = lambda c: F.when(folded, F.translate(c, "ACGT", "TGCA")).otherwise(F.col(c))
    return F.when(is_snv_strict(ref, alt), F.concat(side(ref), F.lit(">"), side(alt)))


def context_class(context="context", ref="ref", alt="alt") -> Column:
    """One of the 96 classes, ``A[C>A]T``, from the three reference bases around the site."""
    folded = F.col(ref).isin("A", "G")
    three = F.when(folded, F.reverse(F.translate(context, "ACGT", "TGCA"))).otherwise(F.col(context))
    return F.concat(F.substring(three, 1, 1), F.lit("["), substitution_class(ref, alt), F.lit("]"), F.substring(three, 3, 1))


def mutation_spectrum(table: DataFrame) -> DataFrame:
    """SNP / DBS / INDEL and six-class counts per sample."""
    kind = lambda k: F.count_if(F.col("mut_type") == k).alias(k.lower())
    sub = substitution_class()
    return table.groupBy("sample_id").agg(
        kind("SNP"), kind("DBS"), kind("INDEL"), *[F.count_if(sub == s).alias(s.replace(">", "_to_")) for s in SUBSTITUTIONS])


def context_counts(table: DataFrame, context: str = "context") -> DataFrame:
    """Counts per sample and 96-class, long."""
    snv = table.filter(is_snv_strict())
    return snv.groupBy("sample_id", context_class(context).alias("context_class")).agg(F.count(F.lit(1)).alias("n"))


def merge_activities(*parts: DataFrame) -> DataFrame:
    """Union of long activity tables; whole numbers, an absent signature is simply absent (0 when widened)."""
    out = parts[0].select("sample_id", "signature", "activity")
    for p in parts[1:]:
        out = out.unionByName(p.select("sample_id", "signature", "activity"))
    return out.groupBy("sample_id", "signature").agg(F.floor(F.sum("activity")).alias("activity"))


def widen_activities(activity: DataFrame, signatures: Sequence[str] | None = None) -> DataFrame:
    """Samples x signatures with 0 for absent entries."""
    wide = activity.groupBy("sample_id").pivot("signature", list(signatures) if signatures else None).agg(F.sum("activity"))
    return wide.na.fill(0)


def signature_coverage(variants: DataFrame, activity: DataFrame) -> DataFrame:
    """Input variants, variants assigned to signatures (floored per mutation type) and their share."""
    inputs = variants.groupBy("sample_id").agg(F.count(F.lit(1)).alias("input_variants"))
    per_type = activity.groupBy("sample_id", "mut_type").agg(F.floor(F.sum("activity")).alias("a"))
    assigned = per_type.groupBy("sample_id").agg(F.sum("a").alias("assigned"))
    out = inputs.join(assigned, "sample_id", "left").withColumn("assigned", F.coalesce("assigned", F.lit(0)))
    return out.withColumn("proportion", F.col("assigned") / F.col("input_variants"))


def cohort_assignment(coverage: DataFrame) -> DataFrame:
    """Assigned share of all input variants of the cohort in percent."""
    return coverage.agg((100 * F.try_divide(F.sum("assigned").cast("double"), F.sum("input_variants"))).alias("assigned_pct"))


def signature_stats(activity: DataFrame, n_samples: Column | None = None) -> DataFrame:
    """Mean, sd, coefficient of variation and active samples of each signature, over all samples.

    ``activity`` is long; samples without a row count as 0.
    """
    n = n_samples if n_samples is not None else activity.agg(F.count_distinct("sample_id")).scalar()
    sums = activity.groupBy("signature").agg(
        F.sum("activity").cast("double").alias("s1"), F.sum(F.col("activity") * F.col("activity")).cast("double").alias("s2"),
        F.count_if(F.col("activity") > 0).alias("n_active_samples")).withColumn("n", n)
    mean = F.col("s1") / F.col("n")
    sd = F.sqrt(F.try_divide(F.col("s2") - F.col("s1") * mean, F.col("n") - 1))
    return sums.filter("s1 > 0").select("signature", mean.alias("mean_activity"), sd.alias("sd_activity"), (sd / mean).alias("cv"), "n_active_samples")


def signature_fraction(activity: DataFrame, floor: float = 1e-9) -> DataFrame:
    """Share of a sample's total activity."""
    total = F.sum("activity").over(W.partitionBy("sample_id"))
    return activity.withColumn("fraction", F.col("activity") / F.greatest(total, F.lit(floor)))


def cosine_similarity(aligned: DataFrame, a: str, b: str, empty: float | None = None) -> DataFrame:
    """Cosine of two activity columns per sample; ``empty`` where one has zero length."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    dot, norm = F.sum(x * y), F.sqrt(F.sum(x * x)) * F.sqrt(F.sum(y * y))
    return aligned.groupBy("sample_id").agg(F.coalesce(F.try_divide(dot, norm), F.lit(empty).cast("double")).alias("cosine"))


def detection_rate(aligned: DataFrame, methods: Sequence[str]) -> DataFrame:
    """Percent of samples with activity per signature and method, and how many methods find it."""
    rates = aligned.groupBy("signature").agg(*[(F.avg((F.col(m) > 0).cast("double")) * 100).alias(m) for m in methods])
    found = sum(((F.col(m) > 0).cast("int") for m in methods), F.lit(0))
    return rates.withColumns({"max_rate": F.greatest(*methods), "n_methods": found})


def method_correlation(aligned: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson and Spearman correlation of the sample totals of two methods."""
    totals = aligned.groupBy("sample_id").agg(F.sum(a).cast("double").alias("x"), F.sum(b).cast("double").alias("y"))
    ranked = average_rank(average_rank(totals, "x", out="rx"), "y", out="ry")
    return ranked.agg(F.corr("x", "y").alias("pearson"), F.corr("rx", "ry").alias("spearman"))


def signature_correlation(aligned: DataFrame, a: str, b: str, methods: Sequence[str], min_rate: float = 5) -> DataFrame:
    """Spearman correlation per signature, for signatures some method detects in ``min_rate`` percent of samples."""
    kept = detection_rate(aligned, methods).filter(F.col("max_rate") >= min_rate).select("signature")
    rows = aligned.join(kept, "signature", "left_semi").select("signature", "sample_id", F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
    ranked = average_rank(average_rank(rows, "x", ["signature"], "rx"), "y", ["signature"], "ry")
    return ranked.groupBy("signature").agg(F.corr("rx", "ry").alias("spearman"))


def bray_curtis(long: DataFrame, key: str = "sample_id", feature: str = "signature", value: str = "activity", block: int = 256) -> DataFrame:
    """Distance of every pair of samples, 1 - 2 sum(min) / (sum + sum), as ``(a, b, distance)`` with a < b.

    Samples are packed to one row, dealt into blocks of about ``block`` samples, and each
    pair of blocks is one bounded task: shared features are never joined pair by pair.
    """
    packed = long.groupBy(key).agg(F.collect_list(feature).alias("f"), F.collect_list(F.col(value).cast("double")).alias("v"))
    n = long.agg(F.count_distinct(key)).scalar()
    dealt = packed.withColumn("_n", F.ceil(n / block).cast("int")).withColumn("_b", F.pmod(F.xxhash64(key), F.col("_n")).cast("int"))
    paired = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).select(
        key, "f", "v", "_b", F.least("_b", "_o").alias("i"), F.greatest("_b", "_o").alias("j"))

    def distances(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        names = {f: c for c, f in enumerate(sorted({f for fs in pdf["f"] for f in fs}))}
        mat = np.zeros((len(pdf), len(names)))
        for r, (fs, vs) in enumerate(zip(pdf["f"], pdf["v"])):
            np.add.at(mat[r], [names[f] for f in fs], vs)
        ids, blocks, total = pdf[key].to_numpy(), pdf["_b"].to_numpy(), mat.sum(axis=1)
        left, right = np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)
        parts = []
        for r in left:
            others = right[right > r] if i == j else right
            shared = np.minimum(mat[others], mat[r]).sum(axis=1)
            size = total[others] + total[r]
            dist = np.where(size > 0, 1 - 2 * shared / np.where(size > 0, size, 1), np.nan)
            first = np.where(ids[others] < ids[r], ids[others], ids[r])
            second = np.where(ids[others] < ids[r], ids[r], ids[others])
            parts.append(pd.DataFrame({"a": first, "b": second, "distance": dist}))
        return pd.concat(parts) if parts else pd.DataFrame({"a": [], "b": [], "distance": []})

    return paired.groupBy("i", "j").applyInPandas(distances, "a string, b string, distance double")


def _nnls(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Non-negative least squares by an active set."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, dtype=bool)
    gram, target = a.T @ a, a.T @ y
    for _ in range(100 * n + 100):
        slope = np.where(passive, -np.inf, target - gram @ x)
        best = int(np.argmax(slope))
        if slope[best] <= 1e-10 * max(1.0, np.abs(target).max()):
            return x
        passive[best] = True
        while True:
            on = np.flatnonzero(passive)
            trial = np.zeros(n)
            trial[on] = np.linalg.lstsq(gram[np.ix_(on, on)], target[on], rcond=None)[0]
            if (trial[on] > 0).all():
                x = trial
                break
            bad = on[trial[on] <= 0]
            step = np.min(x[bad] / np.maximum(x[bad] - trial[bad], 1e-300))
            x = x + step * (trial - x)
            passive &= x > 1e-12
            x[~passive] = 0.0
            if not passive.any():
                break
    raise ArithmeticError("non-negative least squares did not converge")


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    d = np.linalg.norm(a) * np.linalg.norm(b)
    return float(a @ b / d) if d > 0 else 0.0


class _Refit:
    """Backward elimination of one sample on one catalog, by Gram matrix.

    Dropping signature k from a fit on the set P moves the others by -x_k / H_kk times column k of H, the inverse of the Gram matrix of P:
    one factorisation serves every trial of a round. A trial is the non-negative fit if it stays positive and no signature outside P
    would gain; only otherwise it is fitted anew.
    """

    def __init__(self, weights: np.ndarray, y: np.ndarray):
        self.weights, self.gram, self.target, self.norm = weights, weights.T @ weights, weights.T @ y, float(y @ y)
        self.y = y

    def cosine(self, x: np.ndarray) -> float:
        size = float(x @ self.gram @ x) * self.norm
        return float(x @ self.target) / np.sqrt(size) if size > 0 else 0.0

    def fit(self, keep: list[int]) -> np.ndarray:
        x = np.zeros(len(self.target))
        x[keep] = _nnls(self.weights[:, keep], self.y)
        return x

    def without(self, x: np.ndarray, keep: list[int]) -> list[tuple[float, int, np.ndarray]]:
        """(cosine, signature, fit) of each signature left out in turn."""
        on = np.flatnonzero(x > 0)
        try:
            inverse = np.linalg.inv(np.linalg.cholesky(self.gram[np.ix_(on, on)])) if len(on) else np.zeros((0, 0))
            inverse = inverse.T @ inverse
        except np.linalg.LinAlgError:
            inverse = None
        place = {k: i for i, k in enumerate(on.tolist())}
        out = []
        tolerance = 1e-10 * max(1.0, np.abs(self.target).max(initial=0.0))
        for drop in keep:
            rest = [k for k in keep if k != drop]
            if drop not in place:
                out.append((self.cosine(x), drop, x))
                continue
            trial = None
            if inverse is not None and np.linalg.cond(inverse) < 1e10:
                i = place[drop]
                moved = x.copy()
                moved[on] -= x[drop] / inverse[i, i] * inverse[:, i]
                moved[drop] = 0.0
                others = [k for k in rest if k not in place]
                if (moved[on] >= 0).all() and (not others or (self.target[others] - self.gram[others] @ moved).max() <= tolerance):
                    trial = moved
            trial = self.fit(rest) if trial is None else trial
            out.append((self.cosine(trial), drop, trial))
        return out

    def eliminate(self, max_loss: float) -> tuple[np.ndarray, float]:
        keep = list(range(len(self.target)))
        x = self.fit(keep)
        best = self.cosine(x)
        while len(keep) > 1:
            score, drop, fitted = max(self.without(x, keep), key=lambda t: (round(t[0], 12), t[1]))
            if best - score > max_loss:
                break
            keep.remove(drop)
            x, best = fitted, score
        return x, best


GROUP_SAMPLES = 256


def signature_refit(counts: DataFrame, catalog: DataFrame, max_loss: float = 0.004, project: str | None = None) -> DataFrame:
    """Non-negative fit of each sample's class counts to a signature catalog.

    Signatures are dropped one at a time, always the one whose loss costs least (of equal ones the last by name), while the
    reconstruction cosine falls by at most ``max_loss``. ``counts``: ``sample_id, feature, n`` (at most the number of mutation classes per
    sample); ``catalog``: ``feature, signature, weight``. With ``project``, a column of both, every project has its own catalog.

    Samples of a project go in groups of about ``GROUP_SAMPLES``, and each group meets the catalog of its project once, in a
    cogroup; nothing passes through the driver and no catalog is too large to be looked at. Samples without a catalog have no row.
    """
    keys = [project] if project else []
    own = counts.select(*keys, "sample_id", "feature", F.col("n").cast("double").alias("n"))
    sizes = own.groupBy(*keys).agg(F.ceil(F.approx_count_distinct("sample_id") / GROUP_SAMPLES).cast("int").alias("_groups"))
    packed = own.groupBy(*keys, "sample_id").agg(F.collect_list("feature").alias("f"), F.collect_list("n").alias("n"))
    join = lambda df: df.join(sizes, keys) if keys else df.crossJoin(sizes)  # one row a project
    dealt = join(packed).withColumn("_group", F.pmod(F.xxhash64("sample_id"), F.col("_groups")).cast("int"))
    given = catalog.select(*keys, "feature", "signature", F.col("weight").cast("double").alias("weight"))
    given = join(given).withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)))

    def fit(samples: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(samples) or not len(rows):
            return pd.DataFrame({**{c: pd.Series(dtype=object) for c in (*keys, "sample_id", "signature")}, "activity": pd.Series(dtype=float), "cosine": pd.Series(dtype=float)})
        wide = rows.pivot_table(index="feature", columns="signature", values="weight", fill_value=0.0).sort_index()
        place, names, weights = {f: k for k, f in enumerate(wide.index)}, list(wide.columns), wide.to_numpy(dtype=float)
        ids, activities, cosines = [], [], []
        for record in samples.itertuples(index=False):
            y = np.zeros(len(place))
            for f, n in zip(record.f, record.n):
                if f in place and n == n:
                    y[place[f]] += n
            x, cosine = _Refit(weights, y).eliminate(max_loss)
            ids += [record.sample_id] * len(names)
            activities.append(x)
            cosines += [cosine] * len(names)
        return pd.DataFrame({**{k: samples[k].iloc[0] for k in keys}, "sample_id": ids, "signature": names * len(samples), "activity": np.concatenate(activities), "cosine": cosines})

    schema = ", ".join([*(f"`{k}` {counts.schema[k].dataType.simpleString()}" for k in keys), "sample_id string, signature string, activity double, cosine double"])
    kept = [*keys, "_group"]
    return dealt.select(*kept, "sample_id", "f", "n").groupBy(*kept).cogroup(given.select(*kept, "feature", "signature", "weight").groupBy(*kept)).applyInPandas(fit, schema)
