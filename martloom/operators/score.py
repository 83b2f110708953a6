"""Batch scoring of a feature table with a three-branch dense network, and its loss."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.vectors import concat_features

# Feature counts, layers of each branch, units of each layer, branches and outputs.
ENERGY_FEATURES = 5
MFCC_FEATURES = 13
BRANCH_LAYERS = 4
LAYER_UNITS = 64
BRANCHES = ("energy", "mfcc", "central")
OUTPUTS = ("energy_output", "mfcc_output", "real_output")

Layer = tuple[np.ndarray, np.ndarray]


@dataclass(frozen=True)
class BranchWeights:
    """Dense layers per branch and one head per output, each (inputs x units, units)."""

    branches: Mapping[str, Sequence[Layer]]
    heads: Mapping[str, Layer]

    @property
    def size(self) -> int:
        layers = [layer for stack in self.branches.values() for layer in stack]
        return sum(w.size + b.size for w, b in [*layers, *self.heads.values()])


def initial_weights(seed: int, units: int = LAYER_UNITS, layers: int = BRANCH_LAYERS):
    """Untrained weights: uniform within sqrt(6 / (inputs + units)), zero bias."""
    rng = np.random.default_rng(seed)

    def dense(n_in: int, n_out: int) -> Layer:
        bound = np.sqrt(6.0 / (n_in + n_out))
        return rng.uniform(-bound, bound, (n_in, n_out)), np.zeros(n_out)

    inputs = dict(zip(BRANCHES, (ENERGY_FEATURES, MFCC_FEATURES, ENERGY_FEATURES + MFCC_FEATURES)))
    return BranchWeights(
        {
            name: [dense(n if i == 0 else units, units) for i in range(layers)]
            for name, n in inputs.items()
        },
        {name: dense(units, 1) for name in OUTPUTS},
    )


def score_branches(
    df: DataFrame, energy: str, mfcc: str, weights: BranchWeights, keep: Sequence[str]
) -> DataFrame:
    """`keep` columns and the three outputs for every row; NULL outputs where a vector is NULL.

    Only `keep` and the two vectors reach Python, as Arrow batches. The weights are broadcast:
    their size is fixed by the layer widths (40,131 numbers for the full network).
    """
    n_energy = weights.branches["energy"][0][0].shape[0]
    n_mfcc = weights.branches["mfcc"][0][0].shape[0]
    fields = [df.schema[c] for c in keep]
    schema = T.StructType([*fields, *[T.StructField(o, T.DoubleType()) for o in OUTPUTS]])
    shared = df.sparkSession.sparkContext.broadcast((weights.branches, weights.heads))
    kept, outputs = list(keep), list(OUTPUTS)

    def score(batches):
        branches, heads = shared.value

        def matrix(column, rows, width):
            flat = column.take(rows).flatten()
            if len(flat) != len(rows) * width:
                raise ValueError(f"expected vectors of {width} numbers")
            return flat.to_numpy(zero_copy_only=False).astype("float64").reshape(-1, width)

        def dense(x, layers):
            for w, b in layers:
                x = np.maximum(x @ w + b, 0.0)
            return x

        def head(x, name):
            w, b = heads[name]
            return 1.0 / (1.0 + np.exp(-(x @ w + b)[:, 0]))

        for batch in batches:
            full = np.logical_and(
                batch.column("_energy").is_valid().to_numpy(zero_copy_only=False),
                batch.column("_mfcc").is_valid().to_numpy(zero_copy_only=False),
            )
            rows = pa.array(np.flatnonzero(full))
            e = matrix(batch.column("_energy"), rows, n_energy)
            m = matrix(batch.column("_mfcc"), rows, n_mfcc)
            central = dense(np.concatenate([e, m], axis=1), branches["central"])
            found = (
                head(dense(e, branches["energy"]) + central, outputs[0]),
                head(dense(m, branches["mfcc"]) + central, outputs[1]),
                head(central, outputs[2]),
            )
            columns = [batch.column(c) for c in kept]
            for values in found:
                spread = np.full(len(full), np.nan)
                spread[full] = values
                columns.append(pa.array(spread, mask=~full))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *outputs])

    given = df.select(*keep, F.col(energy).alias("_energy"), F.col(mfcc).alias("_mfcc"))
    return given.mapInArrow(score, schema)


def score_branches_native(
    df: DataFrame, energy: str, mfcc: str, weights: BranchWeights, keep: Sequence[str]
) -> DataFrame:
    """The same scores with array functions only; meant for layers of a few units."""

    def dot(x, w):
        products = F.zip_with(x, F.lit(w), lambda a, b: a * b)
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

    def literal(values):
        return [float(v) for v in values]

    # each layer is a step of its own: nesting the expressions would repeat them once per unit
    layered = df.select(
        *keep,
        F.col(energy).cast("array<double>").alias("energy"),
        F.col(mfcc).cast("array<double>").alias("mfcc"),
    ).withColumn("central", concat_features(F.col("energy"), F.col("mfcc")))
    depth = max(len(stack) for stack in weights.branches.values())
    for i in range(depth):
        step = {}
        for name, stack in weights.branches.items():
            if i < len(stack):
                w, b = stack[i]
                step[name] = F.array(
                    *[
                        F.greatest(dot(F.col(name), literal(w[:, u])) + float(b[u]), F.lit(0.0))
                        for u in range(w.shape[1])
                    ]
                )
        layered = layered.withColumns(step)

    def head(x, name):
        w, b = weights.heads[name]
        return 1.0 / (1.0 + F.exp(-(dot(x, literal(w[:, 0])) + float(b[0]))))

    def added(a: str):
        return F.zip_with(F.col(a), F.col("central"), lambda p, q: p + q)

    return layered.select(
        *keep,
        head(added("energy"), OUTPUTS[0]).alias(OUTPUTS[0]),
        head(added("mfcc"), OUTPUTS[1]).alias(OUTPUTS[1]),
        head(F.col("central"), OUTPUTS[2]).alias(OUTPUTS[2]),
    )


def branch_loss(
    df: DataFrame,
    y: str,
    loss_weights: Mapping[str, float],
    clip: float = 1e-7,
) -> DataFrame:
    """Weighted sum of the mean binary cross-entropies of the outputs named in `loss_weights`."""

    def cross_entropy(output: str):
        p = F.least(F.greatest(F.col(output), F.lit(clip)), F.lit(1.0 - clip))
        t = F.col(y).cast("double")
        return -(t * F.ln(p) + (1.0 - t) * F.ln(1.0 - p))

    means = {o: F.avg(cross_entropy(o)).alias(f"{o}_loss") for o in loss_weights}
    total = sum(F.col(f"{o}_loss") * float(w) for o, w in loss_weights.items())
    return df.agg(*means.values()).withColumn("loss", total)
