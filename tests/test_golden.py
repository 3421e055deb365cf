"""Golden counts of the fixture pipeline (FIXTURES.md §3), at two scale factors."""

import pytest
from pyspark.sql import functions as F

from tripspark.operators import batching, ingest, quality, versions
from tripspark.plans import frames

SF001, SF01, SF1 = "/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"

GOLDEN = {
    SF001: dict(raw=1000, missing=23, bad=20, sent=957, cleaned=639, sum_km=1652.6438, avg_fare=9.23964,
                last=77, numeric=(53, 100, 154)),
    SF01: dict(raw=10000, missing=223, bad=206, sent=9571, cleaned=5850, sum_km=63575.9542, avg_fare=14.593593,
               last=771, numeric=(500, 1001, 1504), lexical=(500, 971, 1458)),
    SF1: dict(raw=100000, missing=2223, bad=2057, sent=95720, cleaned=58608, sum_km=693685.4858,
              avg_fare=14.946069, last=7720, numeric=(4873, 9771, 14708), lexical=(4873, 9759, 14636)),
}


@pytest.mark.parametrize("sf", [SF001, SF01, SF1])
def test_ingest_and_cleaning(spark, sf):
    g = GOLDEN[sf]
    f = ingest.ingest_funnel(frames.typed(spark, sf)).first()
    assert (f.raw_rows, f.skipped_missing_field, f.skipped_bad_value, f.sent) == (g["raw"], g["missing"], g["bad"],
                                                                                  g["sent"])
    c = frames.cleaned(spark, sf).agg(F.count(F.lit(1)).alias("n"), F.sum("distance_km").alias("km"),
                                      F.avg("fare_amount").alias("fare")).first()
    assert c.n == g["cleaned"]
    assert round(c.km, 4) == g["sum_km"] and round(c.fare, 6) == g["avg_fare"]
    fun = quality.cleaning_funnel(frames.featured(spark, sf)).first()
    assert fun.rows_in == g["sent"] and fun.rows_kept == g["cleaned"]
    assert sum(fun[f"removed_{n}"] for n, _ in quality.RULES) + fun.rows_kept == fun.rows_in


@pytest.mark.parametrize("sf", [SF001, SF01, SF1])
def test_batches_and_versions(spark, sf):
    g = GOLDEN[sf]
    n = batching.fixture_batch_size(spark, sf)
    sizes = {r.batch_no: r.n_rows for r in batching.batch_sizes(frames.trips(spark, sf)).collect()}
    assert len(sizes) == 12 and sizes[12] == g["last"]
    assert all(sizes[b] == n for b in range(1, 12)) and sum(sizes.values()) == g["sent"]
    cat = frames.catalog(spark, sf)
    counts = versions.cumulative_counts(frames.featured(spark, sf), versions.version_batches(cat, 3, "numeric"))
    assert tuple(r.n_cleaned for r in counts.orderBy("version").collect()) == g["numeric"]
    if "lexical" in g:
        lex = versions.cumulative_counts(frames.featured(spark, sf), versions.version_batches(cat, 3, "lexical"))
        assert tuple(r.n_cleaned for r in lex.orderBy("version").collect()) == g["lexical"]
        names = [r.file_name for r in cat.orderBy("pos_lexical").collect()]
        assert names[:4] == ["batch_1.csv", "batch_10.csv", "batch_11.csv", "batch_12_final.csv"]
