"""Array-valued scoring expressions.

Everything is a higher-order function on an array column, so it stays
inside whole-stage codegen and needs no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double_array(arr: Column) -> Column:
    return F.transform(arr, lambda v: v.cast("double"))


def softmax(logits: Column) -> Column:
    """Numerically stable softmax: subtract the row max before ``exp``."""
    x = as_double_array(logits)
    m = F.array_max(x)
    e = F.transform(x, lambda v: F.exp(v - m))
    total = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(e, lambda v: v / total)


def argmax(arr: Column) -> Column:
    """0-based index of the first maximum (``array_position`` finds the first)."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def probability_at(probs: Column, index: Column) -> Column:
    """Probability of the predicted class (0-based index)."""
    return F.element_at(probs, index.cast("int") + 1)


def valid_prediction(digit: Column, confidence: Column, n_classes: int = 10) -> Column:
    """Class in range and probability in [0, 1]."""
    return (digit.between(0, n_classes - 1) & confidence.between(0.0, 1.0)).alias("valid")


def valid_shape(arr: Column, expected: int, lo: float = 0.0, hi: float = 255.0) -> Column:
    """Exactly ``expected`` elements, all inside [lo, hi]."""
    return (F.size(arr) == expected) & F.forall(arr, lambda v: v.between(lo, hi))


def scale_pixels(arr: Column, factor: float = 1.0 / 255.0) -> Column:
    """0..255 -> 0..1."""
    return F.transform(arr, lambda v: v.cast("double") * F.lit(factor))
