"""Accept-or-review decision rule and its texts.

Fixed values that must equal the reference application's output (the
decision labels and the review sentence, in French):
    review label:    "Vérification humaine"
    automatic label: "Tri automatique"
    review sentence: "Le chiffre en position {position} n'atteint que {percent}% de confiance."
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values (see module docstring)
REVIEW_LABEL = "Vérification humaine"
AUTO_LABEL = "Tri automatique"
REASON_PREFIX = "Le chiffre en position "
REASON_MIDDLE = " n'atteint que "
REASON_SUFFIX = "% de confiance."

DEFAULT_THRESHOLD = 0.8


def requires_review(confidence: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """Review when the weakest confidence is strictly below the threshold."""
    return confidence < F.lit(threshold)


def decision(confidence: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    return F.when(requires_review(confidence, threshold), F.lit("review")).otherwise(F.lit("auto"))


def decision_label(confidence: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    return F.when(requires_review(confidence, threshold), F.lit(REVIEW_LABEL)).otherwise(F.lit(AUTO_LABEL))


def whole_percent(confidence: Column) -> Column:
    """Percent rounded half-to-even, as Python's ``{:.0%}`` prints it."""
    return F.bround(confidence * 100, 0).cast("bigint")


def review_reason(confidence: Column, position: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """Sentence naming the weakest position (1-based) and its whole percent;
    NULL when the group is accepted automatically."""
    text = F.concat(F.lit(REASON_PREFIX), position.cast("string"), F.lit(REASON_MIDDLE),
                    whole_percent(confidence).cast("string"), F.lit(REASON_SUFFIX))
    return F.when(requires_review(confidence, threshold), text)
