"""Top-k, mixing, near-duplicates, repeated strings and the pipeline against brute force."""
import glob
import hashlib
import importlib
import os
import random
import sys

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import types as T

from msgledger.llm import mixing, near, repeats, simhash, topk
from msgledger.llm.common import documents
from msgledger.llm.graph import components
from msgledger.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from check_oracles import normal  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLES[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(df.columns, df.collect()) == normal(columns, res.fetchall())


# Top-k.

def slow_top(rows, k=5, every=50):
    good = sorted({(i, tuple(np.floor(256 * np.array(v, float)).astype(int))) for i, v in rows
                   if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    out = []
    for i, q in good:
        if i % every == 0:
            best = sorted((-int(np.dot(q, v)), j) for j, v in good if j != i)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(best, 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, id long, q string")


def top(spark, rows, **kw):
    df = vectors(spark, rows)
    return sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0"), **kw).select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "whole"])
def test_top_k(spark, kind, monkeypatch):
    monkeypatch.setattr(topk, "SAMPLE", 40)
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "FIRST", 1)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 6))
    if kind == "clusters":
        x = rng.normal(size=(5, 6))[rng.integers(0, 5, 400)] * 3 + rng.normal(size=(400, 6)) * 0.05
    if kind == "copies":
        x[:200] = x[0]
    if kind == "whole":
        x = rng.integers(-1, 2, size=(400, 6)).astype(float)
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    assert top(spark, rows) == slow_top(rows)


def test_top_k_large_components(spark):
    rng = np.random.default_rng(17)
    x = rng.normal(size=(120, 4)) * np.where(np.arange(120) % 50, 1e8, 1)[:, None]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    assert top(spark, rows) == slow_top(rows)
    with pytest.raises(Exception, match="64 bits"):
        top(spark, [(0, [1e30]), (1, [1.0])])


def test_top_k_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [0.5, -1.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [1.0, 1.0]),
            (5, [0.0, 0.0]), (5, [0.0, 0.0]), (100, None), (6, [-1.0, 3.0])]
    assert top(spark, rows) == slow_top(rows)
    assert top(spark, [(0, [1.0])]) == [] == top(spark, [(1, None)])
    short = top(spark, [(0, [1.0, 1.0]), (1, [2.0]), (2, [])])
    assert [(r[2], r[3]) for r in short] == [(1, 2 * 256 * 256), (2, 0)]


def test_top_k_sends_little_to_the_driver(spark):
    """The sample is cut in the tasks, and queries are not broadcast: 4 MB reach the driver, however many tasks there are."""
    rng = np.random.default_rng(23)
    x = rng.normal(size=(20_000, 64)).astype(np.float32)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x)}), "vec_id long, embedding array<float>")
    v = np.floor(256 * x.astype(float))
    want = []
    for i in range(0, len(v), 50):
        score = v @ v[i]
        best = [int(j) for j in np.lexsort((np.arange(len(v)), -score)) if j != i][:5]
        want += [(i, rank, j, int(score[j])) for rank, j in enumerate(best, 1)]
    conf, name = spark.sparkContext._jsc.sc().conf(), "spark.driver.maxResultSize"
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    conf.set(name, "4m")
    try:
        found = topk.top_k(df, df.where("vec_id % 50 = 0")).select("query_id", "rank", "vec_id", "score").collect()
    finally:
        conf.remove(name)
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(tuple(r) for r in found) == want


def test_blocks_hold_what_fits():
    sizes = [3, 4, 1, 9, 2, 8, 8, 17]
    first, parts = topk.deal(sizes, 8)
    assert (first, parts) == ([0, 0, 0, 1, 3, 4, 5, 6], [1, 1, 1, 2, 1, 1, 1, 3])
    for b in range(first[-1] + parts[-1]):
        assert sum(-(-n // m) for n, f, m in zip(sizes, first, parts, strict=True) if f <= b < f + m) <= 8


def test_single_precision_only_where_exact():
    rng = np.random.default_rng(29)
    for most in (100, 2**12, 2**20, 2**29):
        a, b = (rng.integers(-most, most + 1, size=(n, 7)) for n in (30, 50))
        assert (topk.scores(a.astype(float), b.astype(float)).astype(np.int64) == a @ b.T).all()


def test_bounds_hold():
    rng = np.random.default_rng(8)
    x = rng.integers(-500, 500, size=(300, 5)).astype(float)
    index = topk.Index(x[:60], [[i] for i in range(60)], (x**2).sum(axis=1).max(), 30_000)
    cell, far = index.cells(x)
    q = rng.integers(-500, 500, size=(40, 5)).astype(float)
    bound = index.bounds(q, cell, far, far)
    real = np.sqrt(np.maximum((q**2).sum(axis=1)[:, None] + index.top - 2 * q @ x.T, 0))
    assert (bound <= real + 1e-6).all()
    assert np.allclose(index.reach(q, (q @ x.T)[:, 0]), real[:, 0], atol=1e-2)


# Mixing.

WORDS = "doc_id long, text string, source string, size long, u long, block int, shard string"


def mixed_docs(spark, sizes):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(9)}" for _ in range(n)), s, 1, 1, 1, "x") for i, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, WORDS)


def slow_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full, goal = sum(sizes.values()), {s for s in sizes if not sizes[s]}, {}
    while True:
        left = total - sum(most * sizes[s] for s in full)
        share = sum(weight[s] for s in sizes if s not in full)
        goal = {s: most * sizes[s] if s in full else left * weight[s] / share for s in sizes}
        over = {s for s in sizes if s not in full and goal[s] > most * sizes[s]}
        if not over:
            return goal
        full |= over


def test_mixing_meets_targets(spark):
    rng = random.Random(10)
    sizes = [(rng.choice(["a", "a", "a", "b", "c", "d", None, ""]), rng.choice([0, 3, 40, 700])) for _ in range(300)] + [("tiny", 2)]
    docs = mixed_docs(spark, sizes)
    got = mixing.taken(docs, shards=5).collect()
    totals, took, goal = {}, {}, {}
    for (s, n), r in zip(sizes, sorted(got, key=lambda r: r["doc_id"]), strict=True):
        assert r["size"] == n and 0 <= r["taken"] <= 3 * n
        totals[s] = totals.get(s, 0) + n
        took[s] = took.get(s, 0) + r["taken"]
        goal[s] = r["target"]
        assert r["source_size"] >= n
    want = slow_targets(totals)
    assert all(abs(goal[s] - want[s]) < 1e-6 and took[s] == int(goal[s] + 1e-9) for s in totals)
    rows = mixing.mix(docs, shards=5)
    assert rows.columns == [*docs.columns, "shard"]
    by_doc = {}
    for r in rows.select("doc_id", mixing.n_words("text").alias("n")).collect():
        by_doc[r["doc_id"]] = by_doc.get(r["doc_id"], 0) + r["n"]
    assert by_doc == {r["doc_id"]: r["taken"] for r in got if r["taken"]}
    again = mixing.taken(docs.repartition(3), shards=5).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_mixing_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b", None), (1, None, "s"), (1, "", "s"), (2, " \n", None), (2, "x " * 50, "t"), (2, "x " * 50, "t")],
                                 "doc_id long, text string, source string")
    got = mixing.taken(docs).collect()
    assert len(got) == 6 and all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.taken(docs.limit(0)).count() == 0 == mixing.mix(docs.limit(0)).count()
    assert {r["taken"] for r in mixing.taken(docs.where("text IS NULL")).collect()} == {0}


def test_splitting_tree_is_a_partition():
    quotas = np.array([1000, 7, 0, 130])
    parts = [mixing.split(quotas, 13, i, 5) for i in range(13)]
    at = np.zeros(4, int)
    for start, size in parts:
        assert (start == at).all()
        at = at + size
    assert (at == quotas).all()
    assert max(s.sum() for _, s in parts) - min(s.sum() for _, s in parts) <= 4


# Near-duplicates.

def slow_groups(rows):
    def fingerprint(text):
        words = (text or "").encode().lower().split()
        if not words:
            return 0
        found = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), seed=42) for i in range(max(len(words) - 3, 1))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))

    fp = [(d, fingerprint(t)) for d, t in rows]
    parent = list(range(len(fp)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fp)):
        for j in range(i):
            if (fp[i][1] ^ fp[j][1]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(fp):
        least.setdefault(find(i), []).append(d)
    return sorted(((d, f"{f:016x}", min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, f) in enumerate(fp)), key=repr)


def test_near_duplicates(spark):
    rng = random.Random(11)
    base = [f"word{i}" for i in range(160)]
    texts = []
    for _ in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(160)] = f"new{rng.randrange(40)}"
        texts.append(" ".join(w).replace("word", rng.choice(["word", "Word"])))
    texts += [None, "", " \n", "one", "one two", "ONE two", "É é"] + ["same text again and again"] * 40
    rows = list(enumerate(texts)) + [(3, "repeated id"), (None, "one"), (None, "only null ids here at all"), (None, "only null ids here at all")]
    docs = spark.createDataFrame([(d, t, 5, "x", 2) for d, t in rows], "doc_id long, text string, fp long, component_id string, id int")
    got = sorted((tuple(r) for r in simhash.groups(docs).collect()), key=repr)
    assert got == slow_groups(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = {(d, c) for d, _, c in got if d == c}
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in want}
    assert simhash.groups(docs.limit(0)).count() == 0 == simhash.keep_one(docs.limit(0)).count()


def test_variants_find_every_pair_of_four_bits():
    rng = random.Random(12)
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << bit
        x = simhash.variants(np.array([a, b], np.uint64).view(np.int64))
        assert (x[0] == x[1]).any()


def test_components(spark):
    rng = random.Random(13)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)]
    edges += [tuple(rng.sample(range(200, 400), 2)) for _ in range(150)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame([(max(e), min(e)) for e in edges], "hi long, lo long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {x: find(x) for e in edges for x in e if find(x) != x}


# Repeated strings.

def slow_repeats(rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            w = b[i:i + 50]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < d:
                gone[i:i + 50] = [True] * 50
        runs = sum(g and not p for p, g in zip([False, *gone], gone, strict=False))
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("piece", [1 << 20, 300])
def test_repeats(spark, monkeypatch, piece):
    monkeypatch.setattr(repeats, "PIECE", piece)
    monkeypatch.setattr(repeats, "HELD", 2000)
    rng = random.Random(14)
    base = "".join(rng.choice("abcd ") for _ in range(3000))
    texts = []
    for _ in range(150):
        parts = [base[(a := rng.randrange(2900)):a + rng.randint(10, 200)] + rng.choice(["", "x", "yy"]) for _ in range(rng.randint(0, 6))]
        texts.append("".join(parts))
    texts += ["a" * 500, "a" * 49, "a" * 50, None, "", "é" * 200, "zé" * 200, "é" * 30] + ["copy " * 20] * 30
    rows = list(enumerate(texts)) + [(3, base[:200]), (3, base[:200])]
    docs = spark.createDataFrame([(d, t, b"x", 1, 2) for d, t in rows], "doc_id long, text string, left binary, kind int, at long")
    got = repeats.remove_repeats(docs, keep_bytes=False)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "left").collect()) == slow_repeats(rows)


def test_repeats_keep_bytes_and_odd_rows(spark):
    text = "0123456789" * 6
    docs = spark.createDataFrame([(1, text), (2, f"<{text}>"), (None, text), (None, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in repeats.remove_repeats(docs).collect() if r["doc_id"]}
    assert bytes(got[2]["left"]) == b"<>" and [(s["start"], s["end"]) for s in got[2]["spans"]] == [(1, 61)]
    assert bytes(got[1]["left"]) == text.encode() and got[1]["spans"] == []
    assert repeats.remove_repeats(docs).where("doc_id IS NULL AND n_removed > 0").count() == 0
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


# Near copies.

def five_words(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def slow_distinct(rows, similar=0.8):
    """Ids that are not linked, through others or not, to a smaller one."""
    sets = {}
    for d, t in rows:
        sets.setdefault(d, []).append(five_words(t))
    least = {d: d for d in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and any(x and y and len(x & y) >= similar * len(x | y) for x in sets[a] for y in sets[b])]
    for _ in range(len(sets)):
        before = dict(least)
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
        if least == before:
            break
    return {d for d in sets if least[d] == d}


def near_texts():
    rng = random.Random(21)
    texts = []
    for k in range(60):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 300))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            w = list(base)
            for _ in range(rng.randint(1, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(100)}"
            texts.append(" ".join(w).upper() if rng.random() < 0.3 else "\n".join(w))
    return texts


def test_near_copies_equal_plain_version(spark):
    texts = [*near_texts(), None, "", " \n", "one", "ONE", "one two three four", "y " * 50_000]
    rows = list(enumerate(texts)) + [(3, "repeated id"), (5, texts[5])]
    docs = spark.createDataFrame([(d, t, 1, 2, "s") for d, t in [*rows, (None, texts[0])]], "doc_id long, text string, id int, hi int, s string")
    kept = near.keep_distinct(docs)
    assert kept.columns == docs.columns
    got = [r["doc_id"] for r in kept.collect()]
    assert {d for d in got if d is not None} == slow_distinct(rows) and got.count(None) == 1
    assert near.keep_distinct(docs.limit(0)).count() == 0


def test_near_copies_are_recalled(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, "/root/testdata/sf0.01").where("length(text) > 300").collect()]
    sets = {d: five_words(t) for d, t in rows}
    by_shingle = {}
    for d, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(d)
    met = {(max(a, b), min(a, b)) for ids in by_shingle.values() if len(ids) < 50 for a in ids for b in ids if a != b}
    want = {(a, b) for a, b in met if 0.8 <= len(sets[a] & sets[b]) / len(sets[a] | sets[b]) < 0.95}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r["doc_id"] for r in near.keep_distinct(docs).collect()}
    found = sum(not (a in left and b in left) for a, b in want)
    assert want and found >= 0.9 * len(want)


# The pipeline.

def test_pipeline(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = documents(spark, SF)
    steps = []
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        steps.append([r.asDict() for r in docs.collect()])
    good, unlined, single, mixed, encoded = steps
    assert all(tuple(s[0]) == pipeline.COLUMNS for s in steps[:4])
    assert {r["doc_id"] for r in unlined} == {r["doc_id"] for r in good}
    groups = slow_groups([(r["doc_id"], r["text"]) for r in unlined])
    apart = {d for d, _, c in groups if d == c}
    assert {r["doc_id"] for r in single} == slow_distinct([(r["doc_id"], r["text"]) for r in unlined if r["doc_id"] in apart])
    assert len(single) < len(apart)
    words = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in single}
    took = {}
    for r in mixed:
        took[r["doc_id"]] = took.get(r["doc_id"], 0) + len(r["text"].encode().split())
    assert all(took[d] <= 3 * words[d] for d in took)
    assert len(encoded) == len(mixed) and all(r["round_trip"] for r in encoded)
    assert sorted(r["doc_id"] for r in encoded) == sorted(r["doc_id"] for r in mixed)
    assert [c for c in pipeline.run(spark, SF).columns] == list(encoded[0])


def test_pipeline_takes_empty_tables(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = documents(spark, SF).limit(0)
    odd = spark.createDataFrame([(None, None, None, None, None, 1), (1, "", "en", "s", 0, 2)], T.StructType([*docs.schema.fields, T.StructField("extra", T.LongType())]))
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
        stage(spark, odd, SF).collect()


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def test_near_copies_meet_in_a_band_of_many(spark, monkeypatch):
    """Pairs of near copies in one band that are unlike its chosen members, and a group of equal sets."""
    for name in ("_FACTORS", "_OFFSETS"):  # all texts share every band
        monkeypatch.setattr(near, name, np.zeros(near.BANDS * near.ROWS, np.uint64))
    rows = [(2 * k + j, " ".join(f"w{k}x{i}" for i in range(60)) + (" end" if j else "")) for k in range(30) for j in (0, 1)]
    rows += [(100 + j, " ".join(f"v{i}" for i in range(40))) for j in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r["doc_id"] for r in near.keep_distinct(docs).collect()) == [2 * k for k in range(30)] + [100]
