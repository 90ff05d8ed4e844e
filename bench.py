"""Headline benchmark: prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

Every query is forced with a ``noop`` write (the full plan runs, nothing is collected).
The stop-word removal runs replicate ``documents`` to 500,000 texts, the size of the
analysed pipeline's largest timing, and report texts/s next to the seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from dailywire.functions import text as TX  # noqa: E402
from dailywire.functions.lexicons import STOPWORDS_FIRST_100  # noqa: E402
from dailywire.plans.registry import load_all  # noqa: E402
from dailywire.session import get_spark  # noqa: E402
from dailywire.sources.readers import table  # noqa: E402

HEADLINE = [
    "daily_news_readings",
    "T6_preprocess_text",
    "N5_valence_class",
    "N8_category_jaccard",
    "W2_tfidf",
    "W5_vocabulary",
    "E7_extract_headline",
    "E13_assemble_articles",
    "A8_forward_fill",
    "A14_best_by_score",
    "F1_forecast_trend_seasonal",
    "F6_arima_order_search",
]
N_TEXTS = 500_000
BASELINE_BEST_TEXTS_PER_SEC = {"k100": 11_966.0, "k2070": 5_948.0}
# the long list: the most frequent words of the documents
LONG_LIST = 2070


def run_noop(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", app="dailywire-bench", shuffle_partitions=int(cpus) * 2)
    reg = load_all()
    times: dict[str, float] = {}
    extra: dict[str, float] = {}

    # warm-up on the smallest tables: JIT / codegen caches are a one-time cost (not timed)
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warm_dir = warm_dir if os.path.isdir(warm_dir) else sf_dir
    for name in ("A3_daily_index_mean", "daily_news_readings", "T6_preprocess_text", "E7_extract_headline"):
        run_noop(reg[name].build(spark, warm_dir))

    for name in HEADLINE:
        t0 = time.perf_counter()  # build is timed too: some plans checkpoint while building
        df = reg[name].build(spark, sf_dir)
        run_noop(df)
        times[name] = round(time.perf_counter() - t0, 3)

    # stop-word removal throughput (the analysed pipeline's only published timing)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_docs = docs.count()
    copies = max(1, -(-N_TEXTS // n_docs))
    # whole copies only (no global limit funnel); 10,000 documents x 50 = 500,000 texts at sf0.1
    texts = docs.crossJoin(spark.range(copies).withColumnRenamed("id", "copy"))
    texts = texts.repartition(int(cpus) * 4).cache()
    n_texts = texts.count()
    frequent = docs.select(F.explode(TX.blank_tokens(F.lower("text"))).alias("word")).where("word <> ''")
    frequent = frequent.groupBy("word").count().orderBy(F.desc("count"), "word").limit(LONG_LIST)
    lists = {"k100": None, "k2070": [r.word for r in frequent.collect()]}
    for label, words in lists.items():
        col = TX.remove_stopwords("text", STOPWORDS_FIRST_100, lower=False) if words is None else TX.remove_stopwords("text", words, lower=False)
        sec = run_noop(texts.select("doc_id", col.alias("cleaned")))
        times[f"T5_stopwords_{label}_{n_texts}"] = round(sec, 3)
        extra[f"T5_{label}_texts_per_sec"] = round(n_texts / sec, 1)
        extra[f"T5_{label}_speedup_vs_baseline_best"] = round(n_texts / sec / BASELINE_BEST_TEXTS_PER_SEC[label], 2)
    texts.unpersist()

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": int(cpus), **extra}))


if __name__ == "__main__":
    main()
