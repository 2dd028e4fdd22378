"""Forward pass of a feed-forward network as array expressions over a weight table.

The network is a table with a row per unit: layer and unit counted from 0, the unit's weights, one for each
input, and its bias. Scoring needs no Python worker and no ML runtime, so a model can be kept and applied as data.
"""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNITS = "layer int, unit int, weights array<double>, bias double"


@dataclass(frozen=True)
class Layer:
    """weights: a row per unit."""

    weights: list[list[float]]
    bias: list[float]


def weight_table(spark: SparkSession, layers: Sequence[Layer]) -> DataFrame:
    rows = [(k, u, w, b) for k, layer in enumerate(layers) for u, (w, b) in enumerate(zip(layer.weights, layer.bias, strict=True))]
    return spark.createDataFrame(rows, UNITS)


def read_layers(units: DataFrame) -> list[Layer]:
    """The layers of a weight table. A network's own size goes through the driver, not that of what it scores."""
    rows = sorted((r.layer, r.unit, r.weights, r.bias) for r in units.collect())
    found = []
    for k in range(max((r[0] for r in rows), default=-1) + 1):
        mine = [r for r in rows if r[0] == k]
        width = len(found[-1].bias) if found else len(mine[0][2]) if mine else 0
        if [r[1] for r in mine] != list(range(len(mine))) or any(len(r[2]) != width for r in mine):
            raise ValueError(f"layer {k} is not whole")
        found.append(Layer([r[2] for r in mine], [r[3] for r in mine]))
    if not found:
        raise ValueError("no layers")
    return found


def layers_of(model: PipelineModel) -> list[Layer]:
    """The layers of a trained classifier: hidden units are sigmoid, the last layer is a softmax."""
    (network,) = [s for s in model.stages if isinstance(s, MultilayerPerceptronClassificationModel)]
    sizes, flat, at, found = network.getLayers(), network.weights.toArray(), 0, []
    for inputs, outputs in zip(sizes, sizes[1:]):
        # Column after column, then the biases.
        weights = np.asarray(flat[at : at + inputs * outputs]).reshape(inputs, outputs).T
        at += inputs * outputs
        found.append(Layer(weights.tolist(), np.asarray(flat[at : at + outputs]).tolist()))
        at += outputs
    return found


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


ACTIVATIONS = {"relu": relu, "sigmoid": sigmoid}


def _bound(value: Column, body) -> Column:
    """body(value) with value worked out once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def dense(inputs: Column, layer: Layer) -> Column:
    """The sums of one layer: weights times inputs, plus bias, per unit."""
    products = lambda w: F.zip_with(w, inputs, lambda a, b: a * b)
    return F.zip_with(F.lit(layer.weights), F.lit(layer.bias), lambda w, b: _sum(products(w)) + b)


def softmax(sums: Column) -> Column:
    powers = _bound(F.array_max(sums), lambda top: F.transform(sums, lambda v: F.exp(v - top)))
    return _bound(powers, lambda each: _bound(_sum(each), lambda total: F.transform(each, lambda v: v / total)))


def forward(inputs: Column, layers: Sequence[Layer], activation: str = "relu") -> Column:
    """The probabilities of an array of inputs. NULL among the inputs gives NULL probabilities."""
    hidden = ACTIVATIONS[activation]

    def through(values: Column, rest: Sequence[Layer]) -> Column:
        if len(rest) == 1:
            return _bound(dense(values, rest[0]), softmax)
        return _bound(F.transform(dense(values, rest[0]), hidden), lambda x: through(x, rest[1:]))

    return _bound(inputs, lambda x: through(x, layers))


def network_scores(
    df: DataFrame, units: DataFrame | Sequence[Layer], features: Sequence[str], activation: str = "relu", classes: Sequence[int] | None = None
) -> DataFrame:
    """Add probability, an array with one entry per class, and predicted, the class of the first largest entry.

    classes: the labels in the order of the last layer, 0, 1, 2 … if not given. A NULL feature gives NULL for both.
    """
    layers = read_layers(units) if isinstance(units, DataFrame) else list(units)
    if any(len(w) != len(features) for w in layers[0].weights):
        raise ValueError(f"the first layer does not take {len(features)} inputs")
    names = F.lit(list(classes) if classes is not None else list(range(len(layers[-1].bias))))
    known = F.lit(True)
    for c in features:
        known = known & F.col(c).isNotNull()
    scored = df.withColumn("probability", F.when(known, forward(F.array(*[F.col(c).cast("double") for c in features]), layers, activation)))
    place = F.array_position("probability", F.array_max("probability"))
    return scored.withColumn("predicted", F.get(names, (place - 1).cast("int")))
