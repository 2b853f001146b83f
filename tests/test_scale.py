"""Steps that grow with their rows: no broadcast of what is small on disk only, tasks sized by their work."""

from __future__ import annotations

import datetime as dt

import pytest

from assayspark.operators import profile as P
from assayspark.operators import select as S
from assayspark.operators import signal as G
from assayspark.plans import signal_q as SQ
from assayspark.plans import sources_q as SRC


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("events"))
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=37 * i), i % 3, ("purchase", "view", "click")[i % 3 if i % 5 else 1], float(i % 7)) for i in range(120)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"{d}/events.parquet")
    return d


def test_bins_are_never_broadcast(spark, events):
    y, _ = SQ.y_matrix(spark, events, log_unit=False)
    for df in (y, SQ.annotation(spark, events), y.join(SQ.annotation(spark, events).hint("merge"), ["chrom", "pos"])):
        assert "BroadcastHashJoin" not in plan(df)
        assert df.count() == 3 * df.select("pos").distinct().count()


def test_bins_are_dealt_by_their_number(spark, monkeypatch):
    t = spark.createDataFrame([("a", f"c{i}", 0, 600, 2.0) for i in range(50)] + [("a", "c0", 600, 630, 4.0)], "track string, chrom string, start long, end long, value double")
    monkeypatch.setattr(G, "TASK_BINS", 10)
    got = G.binned_values(t, 60)
    assert "REPARTITION_BY_NUM" in plan(got) and got.rdd.getNumPartitions() == 51
    assert got.count() == 501 and got.where("pos = 10").first()["value"] == 2.0
    assert G.binned_values(t.where("track = 'b'"), 60).count() == 0


@pytest.fixture
def no_auto_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


def test_lines_are_not_dealt_by_file(no_auto_broadcast, tmp_path):
    from assayspark.sources import files as R

    for i, mark in enumerate(("", "#note\n")):
        (tmp_path / f"f{i}.tsv").write_text(mark + "a\tb\n" + "".join(f"{j}\t{i}\n" for j in range(5)))
    t = R.read_tsv_table(no_auto_broadcast, str(tmp_path))
    assert "SortMergeJoin" not in plan(t)
    assert sorted((r["a"], r["b"]) for r in t.collect()) == sorted((str(j), str(i)) for i in range(2) for j in range(5))


def test_mutation_files_grow_with_the_rows(spark, tmp_path, monkeypatch):
    rows = [(i, i % 10, i % 7 + 1) for i in range(300)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = [(i, f"B{i % 3}", "ECONOMY" if i % 2 else "SMALL", i) for i in range(10)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(SRC, "_fresh", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(SRC, "FILE_ROWS", 20)
    got = {r["gene"]: (r["n"], r["n_samples"]) for r in SRC.s02_s03_comment_first_line(spark, str(tmp_path)).collect()}
    assert got == {None: (30, 30), "B0": (120, 120), "B1": (60, 60), "B2": (90, 90)}
    assert len(list((tmp_path / "mut-tsv").glob("part=*"))) == 15


def test_missing_filters_do_not_sort_the_cells(no_auto_broadcast):
    m = no_auto_broadcast.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("c", None), ("c", None), ("c", 1.0), (None, 1.0)], "feature string, value double")
    got = S.drop_missing_rate(S.drop_all_missing(m), 0.5)
    assert "SortMergeJoin" not in plan(got)
    assert sorted(got.collect(), key=str) == sorted(m.where("feature = 'a'").collect(), key=str)


def test_rows_of_a_dataset_stay_where_they_are(no_auto_broadcast):
    m = no_auto_broadcast.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 63.0), (None, 7.0)], "dataset string, value double")
    got = P.log2p1_if_counts(m)
    assert "SortMergeJoin" not in plan(got)
    assert sorted((r["dataset"] or "", r["value"], r["was_raw"]) for r in got.collect()) == [("", 7.0, None), ("a", 1.0, False), ("a", 3.0, False), ("b", 6.0, True)]


def test_mask_draws_once_per_row(spark):
    from pyspark.sql import functions as F

    from assayspark.functions import tokens as K

    ids = [0, 1, 7, 2**31 - 1, 2**31 + 5, 10**15, -3, None]
    df = spark.createDataFrame([(i, list(range(1, 41))) for i in ids], "id long, t array<int>")
    m = K.random_mask(F.col("t"), F.col("id"), 3, 0.15, seed=42)
    one = F.transform("t", lambda t, i: F.when(K.arith_hash(F.col("id"), i, F.lit(3), F.lit(42)) / float(K.HASH_MOD) < 0.15, F.lit(0)).otherwise(t))
    got = df.select(m.alias("m"), one.alias("one"))
    assert all(r["m"] == r["one"] for r in got.collect())
    assert str(m).count("pmod") <= 3


@pytest.mark.parametrize("chunk", [4096, 4])
def test_correlations_are_not_shuffled_by_row(spark, monkeypatch, chunk):
    import numpy as np

    monkeypatch.setattr(P, "CORR_OBS", chunk)
    for name, side in (("CORR_VARS", 3), ("CORR_BLOCKS", 4), ("CORR_ROWS", 5)):
        monkeypatch.setattr(P, name, side)
    x = np.random.default_rng(5).normal(size=(11, 9))
    x[4] = 2.0  # no variance
    cells = [(f"v{i}", j, float(x[i, j])) for i in range(11) for j in range(9)] + [(None, 0, 1.0), ("v1", None, 3.0), ("v0", 77, None)]
    cells = [c for c in cells if c[1] is not None]
    got = P.pairwise_corr(spark.createDataFrame(cells, "feature string, sample int, value double"))
    with np.errstate(invalid="ignore"):
        want = np.corrcoef(x)
    names = [f"v{i}" for i in range(11) if i != 4]
    found = {(r.feature_i, r.feature_j): r.r for r in got.collect()}
    assert got.columns == ["feature_i", "feature_j", "r"] and got.count() == len(names) ** 2
    assert all(abs(found[a, b] - want[int(a[1:]), int(b[1:])]) < 1e-9 for a in names for b in names)
    # Above the products, rows are neither joined nor shuffled.
    top = plan(got).split("MapInArrow" if chunk > 9 else "FlatMapCoGroupsInArrow")[0]
    assert "Join" not in top and "Exchange" not in top


def test_tracks_are_scaled_to_unit_norm(spark, events):
    import math

    got = SQ.a20_track_norms(spark, events)
    assert "Exchange hashpartitioning(track" not in plan(got).split("Scan parquet")[0]
    rows = got.collect()
    binned = {(r["track"], r["chrom"], r["pos"]): r["value"] for r in SQ.binned(spark, events).collect()}
    assert {(r["track"], r["chrom"], r["pos"]) for r in rows} == set(binned) and len(rows) == len(binned)
    for track in ("purchase", "view", "click"):
        norm = math.sqrt(sum(math.log1p(v) ** 2 for k, v in binned.items() if k[0] == track))
        mine = [r for r in rows if r["track"] == track]
        assert mine and norm > 0 and all(abs(r["norm"] - norm) < 1e-6 for r in mine)
        assert all(abs(r["unit"] - math.log1p(binned[track, r["chrom"], r["pos"]]) / norm) < 1e-8 for r in mine)
        assert abs(sum(r["unit"] ** 2 for r in mine) - 1) < 1e-5
