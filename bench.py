"""Time the headline queries at ``$BENCH_SF_DIR`` and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from sentimill.registry.queries import QUERIES
from sentimill.session import local_session

HEADLINE = (
    "sentiment_totals",
    "rolling_sentiment",
    "quarterly_sentiment",
    "cumulative_sentiment",
    "length_funnel",
    "length_histogram",
    "clean_reviews",
    "clean_review_text",
    "term_counts",
    "vocabulary",
    "tfidf",
    "bernoulli_nb_fit",
    "multinomial_nb_fit",
    "score_reviews",
    "cross_validate",
    "nb_grid_search",
    "logistic_fit",
    "svm_fit",
    "svm_cross_validate",
    "lr_grid_search",
    "svm_grid_search",
    "roc_auc",
    "top_reviews_per_product",
    "product_top_reviews",
    "product_negative_text",
    "product_timeline",
    "product_quarterly_sentiment",
    "nmf_topics_five_steps",
    "nmf_topics_finished",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), name="bench")
    # Start-up of the engine is not part of any query.
    QUERIES["row_count"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
