"""Train the classifier on the store, report on held-out posts, save it.

Exit codes: 1 for a missing store, 2 for an empty one.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException

from moodlake.operators import classifier, evaluation, metrics
from moodlake.operators.split import hash_split
from moodlake.session import build_session
from moodlake.sources.store import EmptyStore, read_enriched


def main(argv: list[str] | None = None) -> dict[str, float]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("store")
    parser.add_argument("--model", required=True, help="folder for the pipeline")
    parser.add_argument("--regression", help="folder for the regression alone")
    parser.add_argument("--train-pct", type=int, default=80)
    parser.add_argument("--features", type=int, default=65536)
    parser.add_argument("--max-iter", type=int, default=100)
    parser.add_argument("--cache", action="store_true", help="keep the rows in memory and on local disks")
    parser.add_argument("--rows", type=int, default=1000, help="lines printed per report")
    args = parser.parse_args(argv)

    spark = build_session("moodlake-train")
    try:
        rows = read_enriched(spark, args.store, cache=args.cache)
    except AnalysisException as exc:
        print(f"no store at {args.store}: {exc}", file=sys.stderr)
        sys.exit(1)
    except EmptyStore as exc:
        print(exc, file=sys.stderr)
        sys.exit(2)

    metrics.class_distribution(rows).show(args.rows, truncate=False)
    # Fallback answers of failed calls are no truth to learn from or to be judged by.
    train, test = hash_split(rows.filter("inference_error IS NULL"), train_pct=args.train_pct)
    params = classifier.ClassifierParams(features=args.features, max_iter=args.max_iter)
    model, seconds = classifier.fit_classifier(train, params)
    print(f"fitted in {seconds:.2f} s")

    # The reports need two small columns, so that is all that is kept.
    predictions = classifier.predict(model, classifier.known_labels_only(test, model)).select(
        "sentiment_label", "predicted_label"
    ).persist()
    pair = ("sentiment_label", "predicted_label")
    figures = evaluation.weighted_metrics(predictions, *pair).first().asDict()
    print(figures)
    evaluation.class_report(predictions, *pair).drop("tp").show(args.rows, truncate=False)
    labels = classifier.labels(model)
    evaluation.confusion_matrix(predictions, *pair, classes=labels).show(args.rows, truncate=False)
    predictions.unpersist()
    classifier.save(model, args.model, args.regression)
    return figures


if __name__ == "__main__":
    main()
