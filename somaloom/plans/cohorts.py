"""Somatic filter of many cohorts at once, on sparse counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somaloom.operators import cohorts as K
from somaloom.operators import pileup as P
from somaloom.operators.cascade import CascadePreset
from somaloom.session import cut_lineage


def cohort_filter(
    obs: DataFrame, samples: DataFrame, sex: str = "male", preset: str | CascadePreset = "wgs", q_cut: float = -5, rho_cut: float = 0.1, second_q_cut: float = 2,
) -> dict[str, DataFrame]:
    """Pileup observations (with ``cohort``) and the sample sheet to counts, both passes, cascade, cell counts and funnel.

    The reads are scanned once, for the pileup metrics; those, the sparse counts, the second pass and the cascade are
    written in ``spark.checkpoint.dir`` and read by all later steps.
    """
    cells = cut_lineage(K.number_cells(samples))
    metrics = cut_lineage(P.pileup_metrics(obs, carry=["cohort"]))
    filtered = P.variant_pass(P.artifact_filters(metrics), ["cohort"]).filter("alt <> 'REF'")
    verdicts = filtered.groupBy(*K.KEY).agg(P.pass_fail(F.bool_or("variant_pass")).alias("pileup_verdict"))
    counts = cut_lineage(K.compress(K.entries_from_metrics(metrics), cells))
    first = K.first_pass_verdict(K.first_pass(counts, sex=sex), q_cut, rho_cut)
    second = cut_lineage(K.second_pass(counts, second_q_cut, sex=sex))
    flagged = cut_lineage(K.cascade(counts, second, verdicts, preset))
    return {"cells": cells, "metrics": metrics, "counts": counts, "first_pass": first, "second_pass": second, "cascade": flagged,
            "cell_counts": K.cell_counts(flagged, cells), "membership": K.membership(flagged, counts), "funnel": K.funnel(first, flagged)}
