"""Times every registered query over whole tables and prints one JSON line.

``$BENCH_SF_DIR`` names the tables (default sf0.1), ``$BENCH_CPUS`` the cores, and arguments, if
any, the queries. Results go to the noop sink, so all rows and columns are computed. The retrieval
queries share one index, which ``index_build`` writes first and is timed with the rest.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from passagework.plans import registry
from passagework.session import local_session

RETRIEVAL = {
    "retrieve_passages", "retrieve_relevance", "retrieve_inverted", "stuff_context", "rag_prompt", "retrieval_qa", "qa_documents", "answer_report",
}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(registry.QUERIES)

    def run(query) -> float:
        start = time.perf_counter()
        query(spark, sf).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run(registry.latest_record)  # start the session's machinery outside the clock
    times: dict[str, float] = {}
    if RETRIEVAL & set(names):
        times["index_build"] = run(lambda s, d: registry._index(s, d).idf)
    for name in names:
        times[name] = run(registry.QUERIES[name])
        print(f"{name} {times[name]}", file=sys.stderr)
    scale = re.search(r"sf([0-9.]+)", sf)
    print(
        json.dumps(
            {
                "metric": "total_seconds_all_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
