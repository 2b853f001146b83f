"""Hand fixtures, invariants and properties per operator."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayspark.functions import sequence as Q
from assayspark.functions import tokens as K
from assayspark.functions.images import minmax_channels
from assayspark.operators import profile as P
from assayspark.operators import sampling as X
from assayspark.operators import select as S
from assayspark.operators import windows as W
from assayspark.operators.scoring import adjusted_mutual_info, roc_auc
from assayspark.operators.tv import tv_prox


# --- tv_6: fused lasso ------------------------------------------------------

def test_tv_prox_fixture():
    y = np.array([1, 1, 1, 5, 5, 5], dtype=float)
    assert np.allclose(tv_prox(y, 0.0), y)
    assert np.allclose(tv_prox(y, 0.5), [7 / 6] * 3 + [29 / 6] * 3)
    assert np.allclose(tv_prox(y, 100.0), [3.0] * 6)


def tv_prox_reference(y: np.ndarray, lam: float, iters: int) -> np.ndarray:
    """Slow check: projected gradient on the dual (|z_i| <= lam), x = y - D^T z."""
    z = np.zeros(y.size - 1)
    d_t = lambda z: np.concatenate([[-z[0]], z[:-1] - z[1:], [z[-1]]])
    for _ in range(iters):
        z = np.clip(z + 0.25 * np.diff(y - d_t(z)), -lam, lam)
    return y - d_t(z)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(-10, 10), min_size=2, max_size=30), st.floats(0.01, 5))
def test_tv_prox_matches_dual_solver(ys, lam):
    y = np.array(ys)
    assert np.abs(tv_prox(y, lam) - tv_prox_reference(y, lam, 30000)).max() < 1e-3


def test_bin_means_start_at_the_region(spark):
    """Positions 7 to 26 in bins of 10: two bins from 7; a short last bin is padded with its last value; a gap is left out."""
    full = [("a", p, float(p)) for p in range(7, 27)]
    short = [("b", p, float(p)) for p in range(3, 18) if p not in (5, 6)]
    df = spark.createDataFrame(full + short, "chrom string, pos long, v double").repartition(3)
    got = {(r.chrom, r.bin): r.bin_mean for r in W.bin_means(df, ["chrom"], "pos", "v", 10).collect()}
    b0 = [p for p in range(3, 13) if p not in (5, 6)]
    assert got == {("a", 0): 11.5, ("a", 1): 21.5, ("b", 0): sum(b0) / 8, ("b", 1): (13 + 14 + 15 + 16 + 17 * 6) / 10}


# --- matrix_4x3 / mut_8 -------------------------------------------------------

@pytest.fixture()
def matrix_4x3(spark):
    rows = [
        ("g1", "s1", 1.0), ("g1", "s2", None), ("g1", "s3", 3.0),
        ("g2", "s1", 2.0), ("g2", "s2", 2.0), ("g2", "s3", 2.0),
        ("g3", "s1", 0.0), ("g3", "s2", 5.0), ("g3", "s3", 10.0),
        ("g3", "s1", 7.0), ("g3", "s2", 7.0), ("g3", "s3", 7.0),
    ]
    df = spark.createDataFrame(rows, "feature string, sample string, value double")
    return df.withColumn("row_idx", F.monotonically_increasing_id())


def test_constant_feature_dropped(matrix_4x3):
    kept = {r.feature for r in P.drop_constant(matrix_4x3).select("feature").distinct().collect()}
    assert "g2" not in kept and "g1" in kept


def test_missing_rate_exactly_half_is_kept(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("b", None), ("b", 1.0)], "feature string, value double")
    kept = {r.feature for r in S.drop_missing_rate(df, 0.5).select("feature").distinct().collect()}
    assert kept == {"a"}


def test_median_impute(matrix_4x3):
    out = P.median_impute(matrix_4x3).where("feature = 'g1' AND sample = 's2'").first()
    assert out.value == 2.0


def test_top_k_ties_and_null(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), (None,), (None,), ("c",)], "g string")
    top = [tuple(r) for r in P.top_k(df, "g", 2).collect()]
    assert top == [("a", 2), ("b", 2)]
    top_null = [tuple(r) for r in P.top_k(df, "g", 1, include_null=True).collect()]
    assert top_null == [(None, 3)]


def test_histogram_last_edge_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "x double")
    h = {r.bin: r["count"] for r in P.histogram(df, "x", 2).collect()}
    assert h == {1: 1, 2: 2}


def test_mean_offdiag_corr_equals_explicit(spark, sf_small):
    from assayspark.views import matrix

    m = matrix(spark, sf_small)
    fast = P.mean_offdiag_corr(m).first().mean_r
    pdf = m.toPandas().pivot(index="sample", columns="feature", values="value")
    c = np.corrcoef(pdf.to_numpy().T)
    n = c.shape[0]
    explicit = (c.sum() - n) / (n * (n - 1))
    assert abs(fast - explicit) < 1e-9


def test_nonsynonymous_filter_keeps_null(spark):
    from assayspark.operators.tidy import not_containing

    df = spark.createDataFrame([("synonymous_variant",), ("missense_variant,synonymous_variant",), (None,), ("stop_gained",)], "c string")
    kept = [r.c for r in df.where(not_containing(F.col("c"), "synonymous_variant")).collect()]
    assert sorted(kept, key=str) == sorted([None, "stop_gained"], key=str)


# --- seq_4: sequences and motifs ----------------------------------------------

def test_motif_scores_need_no_matrix_of_windows(monkeypatch):
    # One-hot windows take (4 x longest motif) numbers for every place of a sequence.
    monkeypatch.delattr(np.lib.stride_tricks, "sliding_window_view")
    rng = np.random.default_rng(2)
    motifs = [(rng.normal(size=(n, 4)), 1.0) for n in (40, 3, 17)]
    seqs = ["".join(rng.choice(list("ACGTN"), p=[0.245] * 4 + [0.02], size=n)) for n in (60, 45, 3, 40, 39, 0)]
    got, _ = Q.score_batch(seqs, motifs)
    for i, s in enumerate(seqs):
        for k, (lod, _) in enumerate(motifs):
            both = [t[p : p + len(lod)] for t in (s, s[::-1].translate(str.maketrans("ACGT", "TGCA"))) for p in range(len(s) - len(lod) + 1)]
            want = [sum(lod[j, "ACGT".index(c)] for j, c in enumerate(w)) for w in both if "N" not in w]
            assert np.isnan(got[i, k]) if not want else abs(got[i, k] - max(want)) < 1e-9


def test_motif_scores_edge_cases():
    lod = np.log2(np.array([[0.97, 0.01, 0.01, 0.01], [0.01, 0.97, 0.01, 0.01], [0.01, 0.01, 0.97, 0.01]]) / 0.25)
    motifs = [(lod, 2.0)]
    mx, hits = Q.score_batch(["ACGTN", "", "AC", "CGTTT", "NNNN"], motifs)
    assert hits[0, 0] == 1.0 and not math.isnan(mx[0, 0])
    assert math.isnan(mx[1, 0]) and hits[1, 0] == 0.0  # empty
    assert math.isnan(mx[2, 0]) and hits[2, 0] == 0.0  # shorter than motif
    assert hits[3, 0] == 1.0  # ACG only on the reverse strand of CGT
    assert math.isnan(mx[4, 0])  # every window holds N


def test_extract_sequences_unknown_chrom_and_truncation(spark):
    from assayspark.operators.joins import extract_sequences
    from assayspark.sources.files import chunk_genome

    g = spark.createDataFrame([("c1", "acgtacgtac")], "chrom string, seq string")
    bed = spark.createDataFrame([(0, "c1", 2, 6), (1, "c1", 8, 20), (2, "cX", 0, 4), (3, "c1", 5, 5)], "row_idx long, chrom string, start long, end long")
    for size in (3, 5):
        out = {r.row_idx: r.seq for r in extract_sequences(bed, chunk_genome(g, size), size).collect()}
        assert out == {0: "GTAC", 1: "AC", 2: "", 3: ""}


def test_reverse_complement_involution(spark):
    df = spark.createDataFrame([("ACGTNacgtn",)], "s string")
    r = df.select(Q.reverse_complement(Q.reverse_complement(F.col("s"))).alias("x"), Q.reverse_complement(F.col("s")).alias("rc")).first()
    assert r.x == "ACGTNacgtn" and r.rc == "nacgtNACGT"


# --- strings_8: tokens -----------------------------------------------------------

def test_tokens_fixture(spark):
    strs = ["CCO", "C1CC1", "C(C", "C)C", "C1CC", "[NH4+]", "C" * 50, ""]
    df = spark.createDataFrame([(s,) for s in strs], "s string")
    out = df.select(
        "s",
        K.valid_for_encoding(F.col("s"), 50).alias("ok"),
        K.well_formed(F.col("s")).alias("wf"),
        K.ring_count(F.col("s")).alias("rings"),
    ).collect()
    got = {r.s: (r.ok, r.wf, r.rings) for r in out}
    assert got["CCO"] == (True, True, 0)
    assert got["C1CC1"] == (True, True, 1)
    assert got["C(C"][1] is False and got["C)C"][1] is False and got["C1CC"][1] is False
    assert got["[NH4+]"] == (True, True, 0)
    assert got["C" * 50][0] is False  # length >= max_len
    assert got[""][0] is False


def test_encode_decode_eos_and_guard(spark):
    df = spark.createDataFrame([([0, 2, 3],), ([2, 0, 1],), ([2, 5, 0, 0],)], "t array<int>")
    r = df.select(K.decode(F.col("t")).alias("d"), K.decode_guarded(F.col("t")).alias("g"),
                  K.mask_to_first_eos(F.col("t")).alias("m")).collect()
    assert r[0].d == "" and r[0].m == [1, 0, 0]  # EOS at position 0
    assert r[1].g == "x"  # SOS after EOS still trips the guard
    assert r[2].d == "CO" and r[2].m == [1, 1, 1, 0]


@settings(max_examples=20, deadline=None)
@given(st.text(alphabet=K.STRING_CHARS, min_size=1, max_size=40))
def test_encode_roundtrip_property(spark, s):
    r = spark.createDataFrame([(s,)], "s string").select(K.decode(K.encode(F.col("s"), 50)).alias("d")).first()
    assert r.d == s


# --- labels_10: splits, folds, weights -------------------------------------------

@pytest.fixture()
def labels_10(spark):
    labels = [0] * 5 + [1] * 4 + [2] * 1
    return spark.createDataFrame([(i, l) for i, l in enumerate(labels)], "id long, label int")


def test_stratified_split_sizes(labels_10):
    out = X.stratified_split(labels_10, "id", "label", 0.2, seed=3)
    n_val = out.where("split = 'val'").count()
    assert n_val == math.ceil(0.2 * 10)


def test_fold_sizes_within_one(labels_10):
    f = X.stratified_folds(labels_10, "id", "label", 5).groupBy("fold").count().collect()
    sizes = [r["count"] for r in f]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 10


def test_empty_class_in_bincount(spark, labels_10):
    dom = spark.range(4).select(F.col("id").cast("int").alias("label"))
    cc = {r.label: r["count"] for r in P.class_counts(labels_10, "label", dom).collect()}
    assert cc == {0: 5, 1: 4, 2: 1, 3: 0}


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_row_number_partition_independent(spark, parts):
    df = spark.range(200).select((F.col("id") % 3).alias("k"), F.col("id"))
    rn = W.row_number_within(df, ["k"], ["id"], "rn", partitions=parts)
    got = sorted((r.k, r.id, r.rn) for r in rn.collect())
    exp = sorted((k, i, n + 1) for k in range(3) for n, i in enumerate(sorted(x for x in range(200) if x % 3 == k)))
    assert got == exp


def test_weighted_sample_exact_draws(spark, labels_10):
    w = labels_10.withColumn("w", F.lit(1.0))
    s = X.weighted_sample(w, "id", "w", 37)
    assert s.count() == 37


# --- scoring ----------------------------------------------------------------------

def test_ami_identity(spark):
    df = spark.createDataFrame([(i % 3, i % 3) for i in range(30)], "a int, b int")
    assert abs(adjusted_mutual_info(df, "a", "b").first().ami - 1.0) < 1e-9


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)], "s double, y int")
    assert abs(roc_auc(df, "s", "y").first().auc - 0.875) < 1e-12


# --- images --------------------------------------------------------------------------

def test_constant_channel_variants(spark):
    df = spark.createDataFrame([([[0.5] * 4, [0.0, 1.0, 2.0, 4.0]],)], "c array<array<double>>")
    keep = df.select(minmax_channels(F.col("c")).alias("x")).first().x
    zero = df.select(minmax_channels(F.col("c"), constant_to_zero=True).alias("x")).first().x
    assert keep[0] == [0.5] * 4 and zero[0] == [0.0] * 4 and keep[1] == [0.0, 0.25, 0.5, 1.0]


# --- NMF invariants ---------------------------------------------------------------------

def test_nmf_nonnegative_and_error_decreases(spark):
    from assayspark.operators.nmf import nmf_fused_lasso

    rng = np.random.default_rng(0)
    w0, h0 = rng.random((200, 3)), rng.random((3, 5))
    y = w0 @ h0
    df = spark.createDataFrame([("c1", i, [float(v) for v in y[i]]) for i in range(200)], "chrom string, pos long, y array<double>")
    res = nmf_fused_lasso(df, 3, bin_size=20, fl_every=3, num_iter=8, l2=1e-6, fl=0.0, tol=0.0)
    errs = [h["rel_err"] for h in res.history]
    assert all(b <= a + 1e-9 for a, b in zip(errs, errs[1:]))
    assert (res.H >= 0).all()
    w = np.array([r.w for r in res.W().collect()])
    assert (w >= 0).all()


def test_nmf_follows_a_dense_run(spark, monkeypatch):
    """Blocks, region-anchored bins and joins give the factors of the same steps on one dense array."""
    from assayspark.operators import nmf as N

    rng = np.random.default_rng(1)
    lo, n, k, b, lam, l2 = 13, 157, 2, 5, 0.2, 0.01
    data = {c: rng.random((n, 4)) for c in ("c1", "c2")}
    df = spark.createDataFrame([(c, lo + i, [float(v) for v in y[i]]) for c, y in data.items() for i in range(n)], "chrom string, pos long, y array<double>")
    y = np.concatenate([data["c1"], data["c2"]])
    H = N.init_h(y.T @ y, k)
    for it in range(4):
        w = np.maximum(y @ np.linalg.solve(H @ H.T + l2 * np.eye(k), H).T, 0)
        if it % 3 == 0:
            for part in (slice(0, n), slice(n, 2 * n)):
                for j in range(k):
                    padded = np.concatenate([w[part, j], np.full(-n % b, w[part, j][-1])])
                    w[part, j] = np.maximum(np.repeat(tv_prox(padded.reshape(-1, b).mean(axis=1), lam), b)[:n], 0)
        H = np.maximum(np.linalg.solve(w.T @ w + l2 * np.eye(k), w.T @ y), 0)
    for parts, block_bins in ((1, N.BLOCK_BINS), (5, 4)):  # 157 positions: one block, or eight a chromosome
        blocks = N.to_blocks(df.repartition(parts), b, block_bins)
        res = N.nmf_fused_lasso(None, k, bin_size=b, fl_every=3, num_iter=4, l2=l2, fl=lam, tol=0.0, blocks=blocks)
        assert np.allclose(res.H, H)
        got = {(r.chrom, r.pos): r.w for r in res.W().collect()}
        assert np.allclose([got[(c, lo + i)] for c in ("c1", "c2") for i in range(n)], w)
        assert np.isclose(N.relative_error(df, res.W(), res.H).first().rel_err, np.linalg.norm(y - w @ H) / np.linalg.norm(y))
        assert np.isclose(res.history[-1]["rel_err"], np.linalg.norm(y - w @ H) / np.linalg.norm(y))


def test_vector_assembly_is_not_quadratic(spark):
    """16,000 variables, some cells missing, in seconds."""
    import time

    from assayspark.operators.vectors import assemble_dense

    n = 16_000
    m = spark.range(6 * n).select((F.col("id") % 6).alias("sample"), F.floor(F.col("id") / 6).alias("feature"), F.col("id").cast("double").alias("value"))
    m = m.where("not (sample = 2 and feature in (0, 7, 15999))")
    t = time.time()
    out, names = assemble_dense(m, fill=-1.0)
    rows = {r.sample: r.features.toArray() for r in out.collect()}
    assert time.time() - t < 40 and len(names) == n
    assert (rows[1] == np.arange(n) * 6 + 1).all()
    want = np.arange(n) * 6.0 + 2
    want[[0, 7, 15999]] = -1
    assert (rows[2] == want).all()


def test_exact_split_after_shuffle_is_exact(spark):
    # Input order after a shuffle is not stable between evaluations; the split size must still be exact.
    base = spark.range(3000).select(F.col("id"), (F.col("id") % 7).alias("g"))
    shuffled = base.join(base.groupBy("g").count(), "g").repartition(5)
    for _ in range(2):
        out = X.exact_split(shuffled, "id", 0.2, seed=1)
        assert out.where("split = 'val'").count() == 600
