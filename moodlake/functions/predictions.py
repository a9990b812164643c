"""From raw model answers to a label, a score and an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from moodlake import schemas
from moodlake.functions.text import _col

LABELS = ("Negative", "Neutral", "Positive")

# The hosted model's label names.
MODEL_LABELS = {"LABEL_0": "Negative", "LABEL_1": "Neutral", "LABEL_2": "Positive"}

# What an unscored post is stored as, and why.
DEFAULT_LABEL = "Neutral"
EMPTY_TEXT = "empty_text"
UNAVAILABLE = "api_unavailable"


def label_name(label: Column | str) -> Column:
    """Readable name of a model label; other labels pass unchanged."""
    label = _col(label)
    out = label
    for raw, name in MODEL_LABELS.items():
        out = F.when(label == raw, name).otherwise(out)
    return out


def default_label(label: Column | str) -> Column:
    """Neutral for a NULL or empty label."""
    return F.coalesce(F.nullif(_col(label), F.lit("")), F.lit(DEFAULT_LABEL))


def unscored(error: str) -> Column:
    """The score struct of a post no model answered for."""
    return F.struct(
        F.lit(DEFAULT_LABEL).alias("label"),
        F.lit(0.0).cast("float").alias("score"),
        F.lit(error).alias("error"),
    )


def top_prediction(response: Column | str) -> Column:
    """Best candidate of a model answer (JSON text) as a score struct.

    Only the first inner list counts; the first of tied scores wins. An answer
    that is no JSON, has no candidates or lacks a score is the unavailable case.
    """
    candidates = F.get(F.from_json(_col(response), schemas.MODEL_RESPONSE), F.lit(0))
    # The largest struct is one without a score, if any, else the one with the
    # highest score and, of ties, the smallest position.
    best = F.array_max(F.transform(candidates, lambda p, i: F.struct(
        p["score"].isNull().alias("unusable"), p["score"].alias("score"), (-i).alias("place"),
        p["label"].alias("label"),
    )))

    def as_score(b: Column) -> Column:
        found = F.struct(
            label_name(b["label"]).alias("label"),
            b["score"].cast("float").alias("score"),
            F.lit(None).cast("string").alias("error"),
        )
        return F.when(~b["unusable"], found).otherwise(unscored(UNAVAILABLE))

    # Binding ``best`` to a lambda variable parses the answer once per row.
    return F.get(F.transform(F.array(best), as_score), F.lit(0))
