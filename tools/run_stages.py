"""Run the bronze -> silver -> gold stages end to end on inputs derived
from the driver tables and landed as files: XML feeds, JSON-lines review
pages, the written lookup plan and JSON-lines lookup responses. Prints the
rows each stage wrote (observed by the write jobs themselves).

    python tools/run_stages.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from lectio.plans import derive as D  # noqa: E402
from lectio.plans import queries as Q  # noqa: E402
from lectio.plans import stages  # noqa: E402
from lectio.session import build_session, scratch_path  # noqa: E402
from lectio.sources.landing import read_landed_pages, read_landed_responses  # noqa: E402


def run(spark, base: str) -> dict:
    """Run every stage on ``base``; returns the root folder and the rows
    each stage wrote."""
    root = scratch_path(spark, "stages")
    p = lambda n: os.path.join(root, n)
    out: dict[str, int] = {}

    feeds = Q._write_feeds(spark, Q._newest(D.feed_rows(spark, base)))  # landed XML feeds
    out.update(stages.books_stage(spark, feeds, p("bronze_rss"), p("silver_books"), D.NEW_BATCH, reports=p("reports")))

    newest = F.col("_ingested_at") == F.lit(D.NEW_BATCH).cast("timestamp")
    (D.review_pages(spark, base).filter(newest).select("goodreads_url", "raw_html")
     .write.mode("overwrite").json(p("landed_pages")))
    stages.pages_stage(spark, p("silver_books"), read_landed_pages(spark, p("landed_pages")),
                       p("bronze_review_pages"), p("silver_books_enriched"), mode="quarantine",
                       batch_ts=D.NEW_BATCH, metrics=out, reports=p("reports"))
    out.update(stages.daily_stage(spark, p("silver_books_enriched"), p("gold_pages_per_day"), reports=p("reports")))

    stages.lookup_plan_stage(spark, p("silver_books"), p("lookup_plan"))
    D.landed_responses(spark.read.parquet(p("lookup_plan"))).write.mode("overwrite").json(p("landed_responses"))
    out.update(stages.lookups_stage(spark, p("lookup_plan"), read_landed_responses(spark, p("landed_responses")),
                                    p("bronze_open_library"), p("silver_open_library"), D.NEW_BATCH,
                                    reports=p("reports")))
    out.update(stages.genre_stage(spark, p("silver_books"), p("silver_open_library"), p("gold_genre"), reports=p("reports")))
    return {"root": root, "rows_written": out}


def main() -> None:
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    print(json.dumps(run(build_session(), base)))


if __name__ == "__main__":
    main()
