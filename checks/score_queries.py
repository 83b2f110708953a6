"""Queries for feature scoring."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from checks.standins import table
from martloom.functions.vectors import concat_features, take_features
from martloom.operators import score

DIGITS = 6


def formula_weights(units: int, layers: int = score.BRANCH_LAYERS) -> score.BranchWeights:
    """Weights from a rule that SQL can repeat: fractions of 64 that depend on position."""

    def dense(shift: int, n_in: int, n_out: int):
        i, o = np.meshgrid(np.arange(n_in), np.arange(n_out), indexing="ij")
        w = ((i * 7 + o * 5 + i * o * 3 + shift) % 23 - 11) / 64.0
        b = ((np.arange(n_out) * 3 + shift) % 5 - 1) / 64.0
        return w, b

    inputs = (score.ENERGY_FEATURES, score.MFCC_FEATURES)
    widths = dict(zip(score.BRANCHES, (*inputs, sum(inputs))))
    return score.BranchWeights(
        {
            name: [
                dense(10 * n + i, width if i == 0 else units, units) for i in range(layers)
            ]
            for n, (name, width) in enumerate(widths.items())
        },
        {name: dense(100 + n, units, 1) for n, name in enumerate(score.OUTPUTS)},
    )


def _features(spark, sf_dir):
    vector = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        (F.col("label") >= 5).cast("int").alias("y"),
        take_features(vector, 1, score.ENERGY_FEATURES).alias("energy"),
        take_features(vector, 1 + score.ENERGY_FEATURES, score.MFCC_FEATURES).alias("mfcc"),
    )


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, DIGITS) for c in cols})


def score_branches(spark, sf_dir):
    scored = score.score_branches(
        _features(spark, sf_dir), "energy", "mfcc", formula_weights(score.LAYER_UNITS), ["vec_id"]
    )
    return _rounded(scored, *score.OUTPUTS)


def score_branches_narrow(spark, sf_dir):
    scored = score.score_branches_native(
        _features(spark, sf_dir), "energy", "mfcc", formula_weights(3), ["vec_id"]
    )
    return _rounded(scored, *score.OUTPUTS)


def branch_loss(spark, sf_dir):
    scored = score.score_branches(
        _features(spark, sf_dir), "energy", "mfcc", formula_weights(score.LAYER_UNITS), ["y"]
    )
    loss = score.branch_loss(scored, "y", dict(zip(score.OUTPUTS, (0.3, 0.3, 1.0))))
    return _rounded(loss, *[f"{o}_loss" for o in score.OUTPUTS], "loss")


def concat_vectors(spark, sf_dir):
    """Every number of the joined vector with its place, and the slice it came from."""
    both = concat_features(F.col("mfcc"), F.col("energy"))
    return _features(spark, sf_dir).select(
        "vec_id", F.posexplode(both).alias("place", "feature")
    )


def _layer_sql(x: str, shift: int, n_in: int, n_out: int) -> str:
    return (
        f"list_transform(range({n_out}), lambda o: greatest(0.0, list_dot_product({x},"
        f" list_transform(range({n_in}),"
        f" lambda i: ((i * 7 + o * 5 + i * o * 3 + {shift}) % 23 - 11) / 64.0::double))"
        f" + ((o * 3 + {shift}) % 5 - 1) / 64.0::double))"
    )


def _head_sql(x: str, shift: int, n_in: int) -> str:
    return (
        f"1 / (1 + exp(-(list_dot_product({x}, list_transform(range({n_in}),"
        f" lambda i: ((i * 7 + {shift}) % 23 - 11) / 64.0::double)) + ({shift} % 5 - 1) / 64.0)))"
    )


def _scores_sql(units: int) -> str:
    steps = [
        """l0 AS (
        SELECT vec_id, cast(label >= 5 AS integer) AS y,
               cast(embedding[1:5] AS double[]) AS energy,
               cast(embedding[6:18] AS double[]) AS mfcc,
               cast(embedding[1:18] AS double[]) AS central
        FROM embeddings)"""
    ]
    for i in range(score.BRANCH_LAYERS):
        layers = ", ".join(
            f"{_layer_sql(name, 10 * n + i, width if i == 0 else units, units)} AS {name}"
            for n, (name, width) in enumerate((("energy", 5), ("mfcc", 13), ("central", 18)))
        )
        steps.append(f"l{i + 1} AS (SELECT vec_id, y, {layers} FROM l{i})")

    def added(a: str) -> str:
        return f"list_transform(range(1, {units + 1}), lambda i: {a}[i] + central[i])"

    heads = ", ".join(
        f"{_head_sql(x, 100 + n, units)} AS {name}"
        for n, (name, x) in enumerate(
            zip(score.OUTPUTS, (added("energy"), added("mfcc"), "central"))
        )
    )
    last = score.BRANCH_LAYERS
    return "WITH " + ", ".join(steps) + f", scores AS (SELECT vec_id, y, {heads} FROM l{last}) "


def _outputs_sql(units: int) -> str:
    rounded = ", ".join(f"round({o}, {DIGITS}) AS {o}" for o in score.OUTPUTS)
    return _scores_sql(units) + f"SELECT vec_id, {rounded} FROM scores"


def _loss_sql() -> str:
    means = ", ".join(
        f"avg(-(y * ln({o}) + (1 - y) * ln(1 - {o}))) AS {o}_loss" for o in score.OUTPUTS
    )
    shown = ", ".join(f"round({o}_loss, {DIGITS}) AS {o}_loss" for o in score.OUTPUTS)
    return (
        _scores_sql(score.LAYER_UNITS)
        + f"SELECT {shown}, round(0.3::double * energy_output_loss"
        + f" + 0.3::double * mfcc_output_loss + real_output_loss, {DIGITS}) AS loss"
        + f" FROM (SELECT {means} FROM scores)"
    )


CHECKS = {
    "score_branches": (score_branches, _outputs_sql(score.LAYER_UNITS)),
    "score_branches_narrow": (score_branches_narrow, _outputs_sql(3)),
    "branch_loss": (branch_loss, _loss_sql()),
    "concat_vectors": (
        concat_vectors,
        "SELECT vec_id, place::INTEGER AS place, v[place + 1] AS feature FROM ("
        "SELECT vec_id, embedding[6:18] || embedding[1:5] AS v, unnest(range(18)) AS place"
        " FROM embeddings)",
    ),
}
