"""Centroid clustering, line dedup and the filter audit against brute force, on given rows and edge cases."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from assayspark.llm import audit, centroids, linededup
from assayspark.llm import queries as Q
from assayspark.session import TABLES
from tests.llm import brute

SF = "/root/testdata/sf0.001"
WS = " \t\n\v\f\r"


@pytest.mark.parametrize("name", ["op11_centroids", "op12_line_dedup", "op13_filter_audit"])
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SF)
    want = con.execute(Q.ORACLES[name])
    cols = [c[0] for c in want.description]
    assert sorted(cols) == sorted(df.columns)
    rows = sorted(map(str, (tuple(r) for r in df.select(*cols).collect())))
    assert rows and rows == sorted(map(str, want.fetchall()))


# ---------------------------------------------------------------- centroids

def brute_clusters(vectors, k, rounds, dims, scale, seed):
    """(id, cluster, distance) by plain Python integers."""
    kept = []
    for i, v in vectors:
        if v is None or len(v) != dims or any(x is None or math.isnan(x) or math.isinf(x) for x in v):
            continue
        lim = centroids.LIMIT
        kept.append((i, [math.floor(max(min(scale * float(x), lim), -lim)) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    mid = [list(v) for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(mid))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        for c, vs in groups.items():
            mid[c] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], mid


def vector_rows():
    rng = random.Random(4)
    base = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(5)]
    rows = [(n, [x + rng.gauss(0, 0.2) for x in rng.choice(base)]) for n in range(300)]
    rows += [(1000 + n, list(base[0])) for n in range(200)]  # one very common vector
    bad = [None, [], [1.0] * 5, [1.0] * 7, [float("nan")] + [0.0] * 5, [float("inf")] + [0.0] * 5, [None] + [0.0] * 5]
    rows += [(2000 + n, v) for n, v in enumerate(bad)]
    rows += [rows[0], (None, base[1]), (None, base[2]), (3000, [1e30, -1e300, 0.0, -0.0, 1e-30, -1e-30])]
    return rows


SCHEMA = "vec_id long, embedding array<double>, id long, cluster string, distance string, v int, h int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", "d", 2, 3) for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("k,rounds", [(8, 10), (3, 1), (8, 0)])
def test_clusters(spark, k, rounds):
    rows = vector_rows()
    got, mid = centroids.cluster_vectors(vector_frame(spark, rows), k=k, rounds=rounds, dims=6)
    want, want_mid = brute_clusters(rows, k, rounds, 6, 1024, 3)
    assert mid.tolist() == want_mid
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.5] * 6), (2, [0.25] * 6), (3, [0.5] * 6)]
    got, mid = centroids.cluster_vectors(vector_frame(spark, rows), dims=6)
    assert mid.shape == (3, 6)
    want, _ = brute_clusters(rows, 8, 10, 6, 1024, 3)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    for empty in ([], [(1, None), (2, [1.0])]):
        got, mid = centroids.cluster_vectors(vector_frame(spark, empty), dims=6)
        assert got.collect() == [] and got.columns == ["vec_id", "cluster", "distance"]
        assert centroids.cluster_table(vector_frame(spark, empty)).collect() == []


def test_blocks_hold_every_vector_at_any_size():
    rng = np.random.default_rng(2)
    v = rng.integers(-300, 300, size=(1000, 4)).astype(np.int32)
    mid = rng.integers(-300, 300, size=(5, 4))
    want = ((v[:, None, :].astype(np.int64) - mid[None]) ** 2).sum(axis=2)
    batches = [pa.record_batch({"id": pa.array(range(lo, lo + 125)), "v": pa.array(v[lo : lo + 125].tolist(), pa.list_(pa.int32()))}) for lo in range(0, 1000, 125)]
    for block in (7, 200, 5000):
        seen = []
        for b in centroids.encode_blocks(batches, 4, block):
            for ids, has, *packed in centroids.decode_blocks(b, 4):
                assert len(ids) <= block and has.all()
                cluster, distance = centroids.nearest(*packed, mid)
                seen += zip(ids.tolist(), cluster.tolist(), distance.tolist(), strict=True)
        assert sorted(seen) == [(i, int(w.argmin()), int(w.min())) for i, w in enumerate(want)]


# ---------------------------------------------------------------- line dedup

DOCS = "doc_id long, text string, lang string, source string, pos int, key string, line string, row string, kept string, n_lines string, gone string"


def doc_frame(spark, rows):
    return spark.createDataFrame([(i, t, la, "s", 1, "k", "l", "r", "x", "y", "g") for i, t, la in rows], DOCS).repartition(3)


def brute_lines(rows, min_chars, min_docs):
    """Per row: (id, n_lines, n_dropped, kept)."""
    key = lambda s: brute.lower(s).strip(WS)
    holders = defaultdict(set)
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add((i is not None, i or 0))
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        me = (i is not None, i or 0)
        gone = [len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and max(holders[key(x)]) != me for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return out


def line_rows():
    rng = random.Random(3)
    pool = ["a common line number %d with enough characters in it" % n for n in range(12)] + ["é" * 39, "é" * 40, "short"]
    deco = [lambda s: s, str.upper, lambda s: "  " + s + "\t", lambda s: s + "\r", lambda s: "\x0b\x0c" + s, lambda s: "\xa0" + s, lambda s: s + " \x85"]
    rows = []
    for n in range(40):
        lines = [rng.choice(deco)(rng.choice(pool)) for _ in range(rng.randint(0, 12))] + ["" for _ in range(rng.randint(0, 2))]
        rng.shuffle(lines)
        rows.append((n, "\n".join(lines), "en"))
    rows += [(100, None, None), (101, "", "en"), (102, "\n\n", "en"), (103, "\n".join([pool[0]] * 3000 + ["x" * 200_000]), "en")]
    rows += [rows[3], (rows[4][0], "other\n" + pool[1] + "\n" + pool[1], "en"), (None, "\n".join(pool), "en"), (None, pool[2], "en")]
    return rows


@pytest.mark.parametrize("min_chars,min_docs", [(40, 5), (1, 2), (40, 1), (10, 30)])
def test_lines(spark, min_chars, min_docs):
    rows = line_rows()
    got = linededup.drop_common_lines(doc_frame(spark, rows), min_chars=min_chars, min_docs=min_docs)
    assert got.columns == [c for c in DOCS.replace(",", "").split()[::2] if c not in ("kept", "n_lines")] + ["n_lines", "n_dropped", "kept"]
    have = sorted(map(str, ((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect())))
    assert have == sorted(map(str, brute_lines(rows, min_chars, min_docs)))


def test_line_table_is_native_and_takes_empty_tables(spark):
    assert linededup.line_table(doc_frame(spark, [])).collect() == []
    df = linededup.line_table(doc_frame(spark, line_rows()))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    for r, (_, _, _, kept) in zip(sorted(df.where("doc_id between 100 and 103").collect()), brute_lines(line_rows(), 40, 5)[40:44], strict=True):
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


# ---------------------------------------------------------------- filter audit

def brute_audit(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    parts = defaultdict(list)
    for i, t, part in rows:
        t = t or ""
        w = brute.WS_WORD.findall(t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and first[t] < i,
        }
        parts[part or ""].append(({x for x, f in fails.items() if f}, i is not None and i in good, i is not None and i in toxic))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left, gone = docs, []
            for step, x in enumerate(order, 1):
                removed = [d for d in left if x in d[0]]
                redundant = sum(x in d[0] for d in gone)
                left, gone = [d for d in left if x not in d[0]], gone + removed
                shapley[x] += len(removed)
                out[part, "".join(order), step] = [
                    len(left), len(removed), redundant, sum(d[0] == {x} for d in docs), sum(d[1] for d in removed), sum(d[2] for d in removed), x,
                ]
        for key in out:
            if key[0] == part:
                out[key][6] = shapley[out[key][6]]
    return {k: tuple(v) for k, v in out.items()}


def audit_rows():
    rng = random.Random(9)
    words = ["alpha", "Beta", "gamma", "delta", "#x", "UPPER", "é"]
    long = lambda n, kinds: " ".join(f"{rng.choice(words[:kinds])}{rng.randint(0, 400 if kinds > 2 else 3)}" for _ in range(n))
    texts = [None, "", " \n", "one", "A" * 50, "a|b", long(200, 1), long(199, 2), long(300, 3), long(250, 5), long(260, 7), "x " * 100_000, "y" * 100_000, "\x85 \xa0"]
    rows = [(n, rng.choice(texts), rng.choice([None, "", "en", "de"])) for n in range(120)]
    return [*rows, rows[5], (None, texts[9], "en"), (None, texts[9], "fr"), (500, texts[9], "it")]


def label_rows():
    rng = random.Random(1)
    rows = [(n, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for n in range(0, 130, 2)]
    return [*rows, (4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]


@pytest.mark.parametrize("filled", [True, False])
def test_audit(spark, filled):
    labels = label_rows() if filled else []
    lab = spark.createDataFrame([(i, q, x, "p", 1) for i, q, x in labels], "doc_id long, quality int, toxic int, part string, mask int")
    got = audit.audit_table(doc_frame(spark, audit_rows()), lab).collect()
    want = brute_audit(audit_rows(), labels)
    have = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got}
    assert len(got) == len(have) == 600 * 5
    assert have == want


def test_audit_of_nothing_and_of_other_filters(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit_table(doc_frame(spark, []), none).collect() == []
    cells = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 1, 3, 0, 1), ("p", 3, 2, 2, 0)], "part string, mask int, n long, good long, toxic long")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in audit.interactions(cells, "XY").collect()}
    assert got == {("XY", 1): (5, 5, 0, 8), ("XY", 2): (5, 0, 2, 2), ("YX", 1): (8, 2, 0, 2), ("YX", 2): (5, 3, 2, 8)}


def test_audit_takes_more_parts_than_one_recursion_may_return(spark):
    cells = spark.createDataFrame([(f"p{n}", 1, 1, 0, 0) for n in range(3500)], "part string, mask int, n long, good long, toxic long")
    assert audit.interactions(cells, "ABCDE").count() == 3500 * 600
