"""Plan checks: filters reach the scan, unused columns are pruned, broadcasts are not forced."""

from pyspark.sql import functions as F

from assayspark.plans.registry import view


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_pruning_reach_parquet(spark, sf_small):
    m = view(spark, sf_small, "matrix_sparse").where(F.col("dataset") == "A").select("feature", "value")
    p = _plan(m)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,A)]" in p
    read = p[p.index("ReadSchema"):].split("\n")[0]
    assert "l_shipdate" not in read and "l_tax" not in read


def test_no_broadcast_hint_in_the_selected_features_join(spark, sf_small):
    """The selected list grows with a parameter: its join is left to Spark, which measures the side."""
    from assayspark.operators.select import variance_select

    out = variance_select(view(spark, sf_small, "matrix"), 0.001, 10)
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()


def test_track_region_filter_pushed(spark, tmp_path):
    from assayspark.sources.files import read_tracks

    d = tmp_path / "t"
    d.mkdir()
    (d / "a.bed").write_text("c1\t0\t10\t1.0\n")
    p = _plan(read_tracks(spark, str(d), chrom="c1", start=5, end=50))
    assert "PushedFilters" in p and "EqualTo(chrom,c1)" in p and "GreaterThan(end,5)" in p
