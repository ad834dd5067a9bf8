"""Headline queries, timed.

Prints one JSON line.  ``queries`` holds the warm time of each query (best of
the repeats), ``cold`` the first run, ``rows_per_s`` the rows of the input
table handled per second when warm.  The language profile and the lexicon are
fitted once; ``langid_fit`` and ``lexicon_fit`` time that, the queries that use
them time the use.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import queries as checks_queries  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from corpusloom.session import builder  # noqa: E402

HEADLINE = {
    "reassemble": "documents", "dedup_first_seen": "documents", "dedup_keep_unique": "documents",
    "token_table": "documents", "vertical_paragraph": "documents", "langid_fit": "documents",
    "langid_predict": "documents", "annotate_tokens": "documents", "bloom_build": "documents",
    "bloom_probe": "documents", "article_text": "pages", "html_blocks": "pages",
    "lexicon_fit": "conversations", "clean_corpus": "pages", "vertical_document": "pages", "profile_by_time": "events",
}
REPEATS = 3


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("bench").master(f"local[{cpus}]")
        .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sizes = {t: spark.read.parquet(f"{sf}/{t}.parquet").count() for t in set(HEADLINE.values())}
    profile, lexicon = checks_queries.profile_of_documents(spark, sf), checks_queries.lexicon(spark, sf)
    checks_queries.profile_of_documents = lambda *_: profile
    checks_queries.lexicon = lambda *_: lexicon
    warm, cold, rate = {}, {}, {}
    for name, table in HEADLINE.items():
        times = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        cold[name], warm[name] = round(times[0], 3), round(min(times[1:]), 3)
        rate[name] = round(sizes[table] / warm[name])
    print(json.dumps({
        "metric": "total warm seconds of the headline queries", "value": round(sum(warm.values()), 3),
        "unit": "sec", "queries": warm, "cold": cold, "rows_per_s": rate, "sf": Path(sf).name,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
