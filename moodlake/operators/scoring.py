"""Sentiment scoring with a pluggable model.

A *scorer* is a function ``list[str] -> list[(label, score)]``. What the
operators take is a *factory* ``() -> scorer``, called once per task on the
executor, so a client or a model is built once for many rows.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from moodlake import schemas
from moodlake.functions.predictions import (
    DEFAULT_LABEL, EMPTY_TEXT, MODEL_LABELS, UNAVAILABLE, default_label, label_name, top_prediction, unscored,
)
from moodlake.functions.text import NEGATIVE_KEYWORDS, POSITIVE_KEYWORDS, has_any, is_blank, keyword_sentiment
from moodlake.session import scratch_table
from moodlake.sources import answers as answers_kept

Scorer = Callable[[list[str]], list[tuple[str, float]]]


class Transient(Exception):
    """The service, not the text, is the trouble; the same call may work later."""


class ModelLoading(Transient):
    def __init__(self, estimated_seconds: float | None = None):
        super().__init__(estimated_seconds)
        self.estimated_seconds = estimated_seconds


class RateLimited(Transient):
    def __init__(self, retry_after: float | None = None):
        super().__init__(retry_after)
        self.retry_after = retry_after


@dataclass(frozen=True)
class RetryPolicy:
    """How often to try a call and how long to wait in between, never after the last."""

    attempts: int = 3
    loading_seconds: float = 20
    loading_cap: float = 30
    rate_limit_seconds: float = 10
    backoff_base: float = 2
    # After so many calls in a row that the service failed, a task makes none for so long.
    rest_after: int = 3
    rest_seconds: float = 60
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic

    def pause(self, error: Exception, attempt: int) -> float:
        if isinstance(error, ModelLoading):
            estimate = self.loading_seconds if error.estimated_seconds is None else error.estimated_seconds
            return min(estimate * attempt, self.loading_cap)
        if isinstance(error, RateLimited):
            return self.rate_limit_seconds if error.retry_after is None else error.retry_after
        return self.backoff_base ** attempt


def _checked(scorer: Scorer, texts: list[str]) -> list[tuple]:
    answers = [(label, float(score)) for label, score in scorer(texts)]
    if len(answers) != len(texts):
        raise ValueError(f"{len(answers)} answers for {len(texts)} texts")
    return [(MODEL_LABELS.get(label, label), score, None) for label, score in answers]


# Failures of the service: those a scorer names so, and all of the network and its clients.
SERVICE_ERRORS = (Transient, OSError)


class Rest:
    """Keeps a task from calling a service that has just failed several times in a row."""

    def __init__(self, retry: RetryPolicy):
        self.retry, self.failures, self.until = retry, 0, None

    def resting(self) -> bool:
        return self.until is not None and self.retry.clock() < self.until

    def note(self, failed: bool) -> None:
        self.failures = self.failures + 1 if failed else 0
        rest = self.failures >= self.retry.rest_after
        self.until = self.retry.clock() + self.retry.rest_seconds if rest else None


def call_scorer(
    scorer: Scorer, texts: list[str], retry: RetryPolicy, rest: Rest | None = None, narrowing: bool = False
) -> list[tuple]:
    """(label, score, error) per text; a text no call answers for gets the fallback.

    When the service itself fails, all texts of the call fall back, as they do
    without a call while the task rests from it. Any other failure may be one
    text's fault, so the call is halved until that text stands alone; the
    halves are not tried again for such a failure, as the whole has been.
    """
    unanswered = [(DEFAULT_LABEL, 0.0, UNAVAILABLE)] * len(texts)
    if rest is not None and rest.resting():
        return unanswered
    error: Exception | None = None
    for attempt in range(1, retry.attempts + 1):
        try:
            answers = _checked(scorer, texts)
            if rest is not None:
                rest.note(failed=False)
            return answers
        except Exception as exc:  # a scorer may raise anything; no row may be lost for it
            error = exc
        if narrowing and not isinstance(error, SERVICE_ERRORS):
            break
        if attempt < retry.attempts:
            retry.sleep(retry.pause(error, attempt))
    service = isinstance(error, SERVICE_ERRORS)
    if rest is not None:
        rest.note(failed=service)
    if len(texts) == 1 or service:
        return unanswered
    half = len(texts) // 2
    return [
        row for part in (texts[:half], texts[half:]) for row in call_scorer(scorer, part, retry, rest, narrowing=True)
    ]


def _scoring_udf(factory: Callable[[], Scorer], retry: RetryPolicy, call_size: int, calls_at_once: int = 1):
    columns = schemas.SCORE.fieldNames()

    @pandas_udf(schemas.SCORE)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer, rest = factory(), Rest(retry)
        with ThreadPoolExecutor(calls_at_once) as pool:
            for texts in batches:
                # Each distinct text of the batch is scored once; NULL has code -1.
                codes, distinct = pd.factorize(texts)
                calls = [list(distinct[i:i + call_size]) for i in range(0, len(distinct), call_size)]
                answers = [row for rows in pool.map(lambda call: call_scorer(scorer, call, retry, rest), calls) for row in rows]
                answers.append((None, None, None))
                table = pd.DataFrame(answers, columns=columns)
                yield table.astype({"score": "float32"}).iloc[codes].reset_index(drop=True)

    # Calls cost time and may fail: Spark must neither repeat nor move them.
    return run.asNondeterministic()


def with_score(df: DataFrame, result: Column) -> DataFrame:
    """Spread a score struct over the three result columns."""
    return df.withColumn("_score", result).select(
        *df.columns,
        default_label(F.col("_score.label")).alias("sentiment_label"),
        F.col("_score.score").alias("confidence_score"),
        F.col("_score.error").alias("inference_error"),
    )


def score(
    df: DataFrame,
    factory: Callable[[], Scorer],
    text: str = "cleaned_text",
    retry: RetryPolicy = RetryPolicy(),
    call_size: int = 64,
    calls_at_once: int = 1,
    tasks: int | None = None,
) -> DataFrame:
    """Add sentiment_label, confidence_score and inference_error to every row.

    Blank text is answered without the model. No shuffle; equal texts within an
    Arrow batch share one answer. ``tasks`` spreads the rows first, for input
    with fewer partitions than the model can serve at once; ``calls_at_once``
    lets each task wait for several calls of a remote model (the scorer must
    then bear threads). Store the result before using it twice: Spark may
    score again what it computes again.
    """
    if tasks:
        df = df.repartition(tasks)
    blank = is_blank(text)
    asked = _scoring_udf(factory, retry, call_size, calls_at_once)(F.when(~blank, F.col(text)))
    return with_score(df, F.when(blank, unscored(EMPTY_TEXT)).otherwise(asked))


def score_distinct(
    df: DataFrame,
    factory: Callable[[], Scorer],
    text: str = "cleaned_text",
    retry: RetryPolicy = RetryPolicy(),
    call_size: int = 64,
    calls_at_once: int = 1,
    hot_share: float = 1e-5,
    tasks: int | None = None,
    remember: str | None = None,
) -> DataFrame:
    """``score``, asking the model once per distinct text of the whole table (batch only).

    Worth its shuffles when calls are dear and texts repeat. Input and answers
    are written to the shared scratch folder once: a source that moves between
    reads cannot bring texts nobody asked about, and a lost executor repeats no
    call. ``tasks`` scoring tasks share the distinct texts (default: the
    session's shuffle partitions; adaptive execution does not merge them). The answers return to the rows by text hash: texts holding more than
    ``hot_share`` of the rows (fewer than 1/hot_share of them, some hundred
    bytes each) by a broadcast join without moving the rows, the others by a
    shuffled join in which no key is hot. A text without an answer is marked
    unavailable. ``scratch_scope`` removes the scratch tables once the result
    is stored. ``remember`` names a table of answers (``sources.answers``): texts found there are not asked about, and new answers
    without an error are added to it, so that a text of one micro-batch is not asked about in a later one.
    """
    if not 1e-5 <= hot_share <= 1:
        raise ValueError("hot_share bounds the broadcast: choose 0.00001 to 1")
    df = scratch_table(df, "asked")
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = (
        df.filter(~is_blank(text)).groupBy(F.col(text).alias("_text")).agg(F.count(F.lit(1)).alias("_rows"))
        .repartition(tasks, "_text")
    )
    texts = texts.withColumn("_key", F.sha2("_text", 256))
    kept = None
    if remember:
        texts = scratch_table(texts, "texts")
        kept = answers_kept.known(texts.select(F.col("_key").alias("key")), remember).withColumnRenamed("key", "_key")
        given = F.struct("label", "score", F.lit(None).cast("string").alias("error")).alias("_answer")
        kept = texts.join(kept, "_key").select("_key", "_rows", given)
        texts = texts.join(kept, "_key", "left_anti").repartition(tasks, "_text")
    answers = scratch_table(
        score(texts, factory, "_text", retry, call_size, calls_at_once).select(
            "_key", "_rows",
            F.struct(
                F.col("sentiment_label").alias("label"),
                F.col("confidence_score").alias("score"),
                F.col("inference_error").alias("error"),
            ).alias("_answer"),
        ),
        "answers",
    )
    if remember:
        new = answers.filter("_answer.error IS NULL")
        if not new.isEmpty():
            answers_kept.remember(new.select(F.col("_key").alias("key"), "_answer.label", "_answer.score"), remember)
        answers = answers.unionByName(kept)
    total = answers.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).first().n
    is_hot = F.col("_rows") > int(total * hot_share)
    hot = F.broadcast(answers.filter(is_hot).select("_key", "_answer"))
    cold = answers.filter(~is_hot).select("_key", "_answer")

    keyed = df.withColumn("_key", F.when(~is_blank(text), F.sha2(text, 256)))
    near = keyed.join(hot, "_key", "left").filter(F.col("_key").isNull() | F.col("_answer").isNotNull())
    far = (
        df.filter(~is_blank(text)).withColumn("_key", F.sha2(text, 256))
        .join(hot, "_key", "left_anti").join(cold, "_key", "left")
    )
    answer = F.when(F.col("_key").isNull(), unscored(EMPTY_TEXT)).otherwise(
        F.coalesce("_answer", unscored(UNAVAILABLE))
    )
    rows = near.unionByName(far).select(*df.columns, answer.alias("_found"))
    return with_score(rows, F.col("_found")).drop("_found")


def score_responses(df: DataFrame, response: str, text: str = "cleaned_text") -> DataFrame:
    """Scores from model answers already at hand as JSON text; native, no Python."""
    blank = is_blank(text)
    return with_score(df, F.when(blank, unscored(EMPTY_TEXT)).otherwise(top_prediction(response)))


def score_columns(df: DataFrame, label: str, confidence: str, error: str, text: str = "cleaned_text") -> DataFrame:
    """Scores from a label, confidence and error column already at hand, with the
    same guards: blank text, then failed calls, then the label's readable name."""
    failed = F.col(error).isNotNull() | F.col(confidence).isNull()
    given = F.struct(
        label_name(label).alias("label"),
        F.col(confidence).cast("float").alias("score"),
        F.lit(None).cast("string").alias("error"),
    )
    result = F.when(is_blank(text), unscored(EMPTY_TEXT)).when(failed, unscored(UNAVAILABLE)).otherwise(given)
    return with_score(df, result)


def score_keywords(df: DataFrame, text: str = "cleaned_text") -> DataFrame:
    """``score`` with ``keyword_scorer`` as a native expression: same answers, no Python."""
    lowered = F.lower(F.col(text))
    both = has_any(lowered, POSITIVE_KEYWORDS) & has_any(lowered, NEGATIVE_KEYWORDS)
    answer = F.struct(
        keyword_sentiment(text, text).alias("label"),
        F.when(both, 0.5).otherwise(1.0).cast("float").alias("score"),
        F.lit(None).cast("string").alias("error"),
    )
    return with_score(df, F.when(is_blank(text), unscored(EMPTY_TEXT)).otherwise(answer))


def keyword_scorer() -> Scorer:
    """A scorer without a model: ``keyword_sentiment`` with the text as tie key,
    sure (1.0) unless both polarities occur (0.5)."""

    def one(text: str) -> tuple[str, float]:
        lowered = text.lower()
        good = any(word in lowered for word in POSITIVE_KEYWORDS)
        bad = any(word in lowered for word in NEGATIVE_KEYWORDS)
        if good and bad:
            even = int(hashlib.md5(text.encode()).hexdigest()[-1], 16) % 2 == 0
            return ("Positive" if even else "Negative", 0.5)
        return ("Positive" if good else "Negative" if bad else "Neutral", 1.0)

    return lambda texts: [one(text) for text in texts]
