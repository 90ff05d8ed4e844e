"""Stop-word removal (T5) throughput at local[2], local[4], local[8]: 500,000 texts, k = 100 and 2,070.

usage: python tools/t5_scaling.py [sf_dir]     (each core count runs in its own Spark process)
"""

from __future__ import annotations

import subprocess
import sys

CHILD = r'''
import json, os, sys, time
sys.path.insert(0, ".")
from dailywire.functions import text as TX
from dailywire.functions.lexicons import STOPWORDS_FIRST_100
from dailywire.session import get_spark
from dailywire.sources.readers import table
from pyspark.sql import functions as F
cpus, sf = int(sys.argv[1]), sys.argv[2]
spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus * 2)
docs = table(spark, sf, "documents").select("doc_id", "text")
copies = -(-500_000 // docs.count())
texts = docs.crossJoin(spark.range(copies)).repartition(cpus * 4).cache()
n = texts.count()
out = {"cpus": cpus, "texts": n}
frequent = docs.select(F.explode(TX.blank_tokens(F.lower("text"))).alias("word")).where("word <> ''")
frequent = frequent.groupBy("word").count().orderBy(F.desc("count"), "word").limit(2070)
lists = {"k100": None, "k2070": [r.word for r in frequent.collect()]}
for label, words in lists.items():
    col = TX.remove_stopwords("text", STOPWORDS_FIRST_100, lower=False) if words is None else TX.remove_stopwords("text", words, lower=False)
    best = None
    for _ in range(2):
        t0 = time.perf_counter()
        texts.select("doc_id", col.alias("c")).write.format("noop").mode("overwrite").save()
        dt = time.perf_counter() - t0
        best = dt if best is None else min(best, dt)
    out[label + "_sec"] = round(best, 3)
    out[label + "_texts_per_sec"] = round(n / best, 1)
print("RESULT " + json.dumps(out))
'''


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    for cpus in (2, 4, 8):
        res = subprocess.run([sys.executable, "-c", CHILD, str(cpus), sf], capture_output=True, text=True, timeout=1800)
        for line in res.stdout.splitlines():
            if line.startswith("RESULT "):
                print(line[7:], flush=True)


if __name__ == "__main__":
    main()
