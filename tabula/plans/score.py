"""Scoring plans.

* ``score_logits``  - logits array -> class, confidence, validity (H11/G8/B10);
  pure array expressions.
* ``score_model``   - a fitted ``PipelineModel`` (preparation + classifier) on
  any number of keyed rows; the key is carried through the transform, so
  results never need re-matching by order (C4, H10).
* ``get_scorer``    - registry of scorers by mode name (H12).
* ``memo_key`` / ``pending`` - content-keyed memo of results (I9; the store
  itself is ``tabula.plans.result_store``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.functions.hashing import content_key
from tabula.functions.scoring import argmax, as_double_array, probability_at, softmax, valid_prediction


class ScorerConfigurationError(RuntimeError):
    """Unknown scorer mode or missing model artifacts."""


def score_logits(df: DataFrame, logits_col: str, id_col: str, first: int = 0, n_classes: int = 10,
                 carry: Sequence[str] = ()) -> DataFrame:
    """``(id, digit, confidence, probability, valid)`` and the ``carry`` columns
    from a logits array (elements ``first .. first+n_classes-1``)."""
    logits = F.slice(as_double_array(F.col(logits_col)), first + 1, n_classes)
    probs = softmax(logits)
    digit = argmax(logits)  # same index as argmax(probs); exp is monotonic
    conf = F.array_max(probs)
    return df.select(id_col, *carry, digit.alias("digit"), conf.alias("confidence"), probs.alias("probability"),
                     valid_prediction(digit, conf, n_classes))


def score_model(model, df: DataFrame, id_col: str, n_classes: int = 10, carry: Sequence[str] = ()) -> DataFrame:
    """Apply a fitted pipeline; keep the key and the ``carry``
    columns; class = ``prediction``, confidence = its probability."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    digit = F.col("prediction").cast("int")
    conf = probability_at(vector_to_array(F.col("probability")), digit)
    return out.select(id_col, *carry, digit.alias("digit"), conf.alias("confidence"),
                      valid_prediction(digit, conf, n_classes))


def get_scorer(mode: str | None, *, model=None, logits_col: str = "logits", id_col: str = "id",
               n_classes: int = 10) -> Callable[[DataFrame], DataFrame]:
    """Choose a scorer by name (trimmed, case-insensitive).

    ``spark`` / ``real`` need a fitted ``model``; ``logits`` scores a logits
    column (the role of the neural scorer). Anything else is an error.
    """
    m = (mode or "").strip().lower()
    if m in {"spark", "real"}:
        if model is None:
            raise ScorerConfigurationError("mode 'spark' needs a fitted model")
        return lambda df: score_model(model, df, id_col, n_classes)
    if m in {"logits", "cnn"}:
        return lambda df: score_logits(df, logits_col, id_col, 0, n_classes)
    raise ScorerConfigurationError(f"unknown scorer mode {mode!r}; use 'spark' or 'logits'")


def memo_key(content: Column, model_name: str, option: bool) -> Column:
    """SHA-256 of (content hash, model, option) - a change of any part is a
    different key, so stale results are simply never matched."""
    return content_key(F.concat(content_key(content), F.lit(f":{model_name}:{str(bool(option)).lower()}")))


def pending(keyed: DataFrame, scored: DataFrame, key: str = "memo_key") -> DataFrame:
    """Rows of ``keyed`` whose key has no stored result (left anti join;
    Spark plans it as a shuffle or broadcast join by the measured size)."""
    return keyed.join(scored.select(key).distinct(), key, "left_anti")
