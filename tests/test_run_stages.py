"""The whole stage flow on landed files derived from the driver tables."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from .conftest import SF001  # noqa: E402


def test_stage_flow_on_derived_landing(spark):
    import run_stages

    done = run_stages.run(spark, SF001)
    out, reports = done["rows_written"], {}
    for name in ("date_rejects", "rejected_pages", "skipped_intervals", "lookup_status", "lookup_errors", "genre_unmatched",
                 "genre_coverage"):
        reports[name] = spark.read.parquet(f"{done['root']}/reports/{name}").collect()
    assert {r.text for r in reports["date_rejects"]} == {"garbage"} and len(reports["rejected_pages"]) > 0
    assert out["bronze_review_pages"] + len(reports["rejected_pages"]) == out["silver_books"]
    assert {r.reason for r in reports["skipped_intervals"]} >= {"missing_start", "missing_finish"}
    counts = {r.status_class: r.n for r in reports["lookup_status"]}
    assert len(reports["lookup_errors"]) == sum(n for c, n in counts.items() if c != "ok") > 0
    assert reports["genre_coverage"][0].books_with_genre > 0 and reports["genre_unmatched"]
    assert 0 < out["silver_books"] <= out["bronze_rss"]
    assert out["silver_books_enriched"] == out["silver_books"]
    assert 0 < out["bronze_review_pages"] <= out["silver_books"]
    assert out["gold_pages_per_day"] > out["silver_books"]
    assert out["silver_open_library"] == out["bronze_open_library"] > 0
    assert out["gold_genre"] > 0
