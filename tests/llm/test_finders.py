"""Secrets, spelling variants and periodic runs on small inputs, next to plain versions."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from msgledger.llm import periods, secrets, spelling

ODD = [None, "", " ", "\n\n", "a", "é" * 30, "日本語 テキスト", "x" * 5000, "a b\tc\x0bd\x0ce\rf", "word " * 3000, "\x00 \x1f", " a "]


def table(spark, texts, ids=None):
    """Extra columns bear the names of results."""
    rows = [(i if ids is None else ids[i], t, "x", 1, "y", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, secrets string, n int, word string, runs string")


def python_free(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Arrow|Pandas|MapIn", plan)


# Secrets.

def slow_secrets(text):
    text, out = text or "", []
    forms = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 12),
             ("access", "AKIA[A-Z0-9]+", 0, 0, 18), ("hex", "[0-9a-f]+", 0, 0, 16)]
    for k, (kind, pattern, flags, group, least) in enumerate(forms):
        out += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text, flags) if len(m.group(group)) >= least]
    for k, c in enumerate(secrets.CLASSES, len(forms)):
        for m in re.finditer(f"[{c.chars}]{{{c.window},}}", text):
            if any(re.fullmatch(a, m.group()) for a in secrets.ALLOWED):
                continue
            spans = []
            for i in range(len(m.group()) - c.window + 1):
                if sum(c.weights[n] for n in Counter(m.group()[i:i + c.window]).values()) > c.limit:
                    continue
                if spans and spans[-1][1] >= i:
                    spans[-1][1] = i + c.window
                else:
                    spans.append([i, i + c.window])
            out += [(m.start() + a, k, m.start() + b, c.kind) for a, b in spans]
    return sorted(out)


def secret_texts():
    rng = random.Random(3)
    lower, b64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

    def some(chars, sizes):
        return "".join(rng.choice(chars) for _ in range(rng.choice(sizes)))

    makers = [
        lambda: rng.choice(["the ", "é日本 ", "\n", " ", "\U0001F600", "-" * 30, "a" * 25, "1" * 22, "internationalization-of-things"]),
        lambda: rng.choice(['token = "', "PassWord:", "api_key='", "apikey==", "token=secret=", "ſecret=", "123e4567-e89b-12d3-a456-426614174000"]),
        lambda: "AKIA" + some(b64[:26] + "0123456789", [13, 14, 16, 40]),
        lambda: some(lower, [10, 15, 16, 19, 20, 21, 40, 300, 900]),
        lambda: some(b64, [11, 12, 19, 20, 24, 40, 600]),
    ]
    texts = ["".join(rng.choice(makers)() for _ in range(rng.randint(1, 40))) for _ in range(60)]
    return ODD + texts + [" ".join(some(lower, [40]) for _ in range(1500))]


def test_secrets_equal_plain_version(spark):
    texts = secret_texts()
    found = secrets.scan(table(spark, texts))
    assert python_free(secrets.digest(found)) and found.columns == ["doc_id", "secrets"]
    got = {r["doc_id"]: [tuple(s) for s in r["secrets"]] for r in found.collect()}
    assert got == {i: slow_secrets(t) for i, t in enumerate(texts)}
    kinds = Counter(s[3] for spans in got.values() for s in spans)
    assert set(kinds) == {"assign", "access", "hex", "entropy_hex", "entropy_base64"}


def test_secret_digests(spark):
    texts = ["token = abcdefghijkl x AKIAABCDEFGHIJKLMN 0123456789abcdef", None]
    one, none = secrets.digest(secrets.scan(table(spark, texts))).orderBy("doc_id").collect()
    base = "assign:0:20,access:23:41,hex:42:58"
    assert one["spans"] == base and one["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert (one["n_assign"], one["n_access"], one["n_hex"]) == (1, 1, 1)
    assert none["spans"] == "" and none["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_secret_rows_and_allow_list(spark):
    random_key = "Zk3vQ9xLp2Rt7Wm5Yc8Hb1Nd"
    docs = table(spark, [random_key, random_key, "plain"], ids=[5, 5, None])
    assert sorted(len(r["secrets"]) for r in secrets.scan(docs).collect()) == [0, 1, 1]
    assert all(not r["secrets"] for r in secrets.scan(docs, allowed=[random_key]).collect())
    assert secrets.scan(docs.limit(0)).count() == 0


# Spelling variants.

def slow_variants(n):
    near = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            cut = w[:k] + w[k + 1:]
            near[w].add(cut)
            for c in spelling.ALPHABET:
                near[w].add(w[:k] + c + w[k + 1:])
    links = {(a, b) for a in n for b in near[a] if b in n and a != b}
    links |= {(b, a) for a, b in links}
    form = {}
    for w in n:
        best = sorted((-n[b], b) for a, b in links if a == w)
        form[w] = best[0][1] if best and -best[0][0] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], sum(a == w for a, _ in links), n[form[w]] if form[w] else None))
    return out


def some_words():
    rng = random.Random(8)
    n = {"abcdefg": 2000, "abcdefgh": 200, "abcdefghi": 20, "abcdefghij": 2, "aaaaaaa": 50, "aaaaaaaa": 50, "ÿààààààà": 3, "ààààààà": 40,
         "bbbbbbb" * 30: 2, "bbbbbbb" * 30 + "c": 30}
    for _ in range(150):
        w = rng.choice(sorted(n))
        k = rng.randrange(len(w))
        w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abcàÿ") + w[k:], w[:k] + rng.choice("abcxÿ") + w[k + 1:]])
        n.setdefault(w, rng.choice([2, 3, 5, 30, 50, 400]))
    return {w: c for w, c in n.items() if len(w) >= 7}


@pytest.mark.parametrize("pass_bytes", [spelling.PASS_BYTES, 64])
def test_variants_equal_plain_version(spark, pass_bytes):
    n = some_words()
    words = spark.createDataFrame([(w, c, "x") for w, c in n.items()], "word string, n long, root string")
    got = {tuple(r) for r in spelling.variants(words, pass_bytes=pass_bytes).collect()}
    assert got == slow_variants(n)


def test_variants_odd_words(spark):
    words = spark.createDataFrame([("", 3), (None, 2), ("日本語日本語日", 5), ("日本語日本語", 50), ("lonelyword", 2)], "word string, n long")
    got = spelling.variants(words).collect()
    assert len(got) == 5 and all(r["form"] is None and r["root"] == r["word"] and r["n_near"] == 0 for r in got)
    assert spelling.variants(words.limit(0)).count() == 0
    two = spark.createDataFrame([("a", 2), ("b", 30), ("", 400)], "word string, n long")
    assert {(r["word"], r["form"], r["root"]) for r in spelling.variants(two).collect()} == {("a", "b", "b"), ("b", None, "b"), ("", None, "")}


def test_filters_deny_no_word_and_few_others():
    rng = random.Random(4)
    words = list({"".join(rng.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(5000)})
    speller, shards = spelling.Speller(spelling.ALPHABET), spelling.Shards.of({9: len(words)})

    def hashes(some):
        return np.concatenate([spelling._mix(speller.sums(rows)[2] + np.uint64(9)) for _, rows in speller.groups(some)])

    h = hashes(words)
    bloom = np.zeros((int(shards.blocks.sum()), 4), np.uint64)
    for lane in range(4):
        np.bitwise_or.at(bloom[:, lane], shards.place(9, h).astype(np.int64), spelling._lane(h, lane))
    others = hashes([w[:-1] + "z" for w in words])
    for h, most in ((h, 1.0), (others, 0.01)):
        block = shards.place(9, h).astype(np.int64)
        passed = np.logical_and.reduce([bloom[block, k] & spelling._lane(h, k) == spelling._lane(h, k) for k in range(4)])
        assert passed.mean() == 1.0 if most == 1.0 else passed.mean() < most


def test_words_of_texts(spark):
    texts = ["Straße×Ende ABCDEFG abcdefg short", None, "", "x" * 100_000]
    rows = table(spark, texts).select("doc_id", F.explode(spelling.words_of(F.col("text"))).alias("word"))
    assert sorted(r["word"] for r in rows.collect()) == ["abcdefg", "abcdefg", "straße×ende", "x" * 100_000]
    assert [(r["word"], r["n"]) for r in spelling.vocabulary(rows).collect()] == [("abcdefg", 2)]


def test_slips(spark):
    words = [(d, f"wort{k}ä") for d in (1, 2, None) for k in range(200)]
    got = sorted(r["word"] for r in spelling.slipped(spark.createDataFrame(words, "doc_id long, word string")).collect())
    want = []
    for d, w in words:
        h = zlib.crc32(f"{d}:{w}".encode())
        k = h % len(w)
        want.append(w[:k] + w[k + 1:] if d is not None and h % 31 == 0 else w)
    assert got == sorted(want) and sum(len(w) < 6 for w in want)


# Periodic runs.

def slow_runs(words, least=24, repeats=3):
    n, out = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, repeats * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in out.items()), key=lambda r: (r[0], r[2]))


def looping(rng, n, kinds):
    words = [rng.randint(1, kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n > 10 else 0):
        a = rng.randrange(n)
        p, m = rng.randint(1, max(1, (n - a) // 3)), rng.randint(0, n - a)
        for i in range(a, a + m):
            words[i] = words[a + (i - a) % p]
    return words


def test_runs_equal_plain_version():
    rng, seen = random.Random(5), 0
    for _ in range(100):
        docs = [looping(rng, rng.choice([0, 1, 5, 23, 24, 25, 40, 100, 300]), rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, 12))]
        for doc, got in zip(docs, periods.find_runs([np.array(d, np.int64) for d in docs]), strict=True):
            assert [tuple(r) for r in got.tolist()] == slow_runs(doc)
            seen += len(got)
    assert seen > 50


def test_runs_in_small_parts(monkeypatch):
    monkeypatch.setattr(periods, "GRID", 7)
    rng = random.Random(6)
    docs = [looping(rng, 200, 2) for _ in range(5)]
    for doc, got in zip(docs, periods.find_runs([np.array(d, np.int64) for d in docs]), strict=True):
        assert [tuple(r) for r in got.tolist()] == slow_runs(doc)


def test_extension_of_long_texts():
    rng = np.random.default_rng(1)
    half = rng.integers(1, 4, 20_000)
    text = np.concatenate([[0], half, [9], half, [0], half[::-1], [0]])
    g = periods.grammar(text)
    assert g.symbol[:len(text)].tolist() == text.tolist()
    x, y = np.array([1, 7, 20_000]), np.array([20_002, 20_008, 40_001])
    assert periods.extension(g, x, y, True).tolist() == [20_000, 19_994, 1]
    assert periods.extension(g, x, y, False).tolist() == [1, 7, 20_000]


def want_row(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = slow_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(), " ".join(w for i, w in enumerate(words) if i not in gone))


def test_periodic_runs_of_a_table(spark):
    rng = random.Random(7)
    texts = ODD + [" ".join(f"w{k}" for k in looping(rng, 150, 3)) for _ in range(20)] + ["a b c " * 20_000]
    texts[9] = "word " * 300  # the plain version is quadratic
    docs = table(spark, texts[:-1])
    got = {r["doc_id"]: r for r in periods.with_best(periods.periodic_runs(docs)).collect()}
    for i, text in enumerate(texts[:-1]):
        r = got[i]
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["runs_sha256"], r["collapsed"]) == want_row(text)
        assert r["collapsed_sha256"] == hashlib.sha256(r["collapsed"].encode()).hexdigest()
    long = periods.with_best(periods.periodic_runs(table(spark, texts[-1:] * 2, ids=[None, None]), keep_text=False)).collect()
    assert [(r["n_runs"], r["length"], r["period"], r["collapsed"]) for r in long] == [(1, 60_000, 3, None)] * 2
    assert periods.with_best(periods.periodic_runs(docs.limit(0))).count() == 0


def test_looped_texts(spark):
    texts = [" ".join(f"w{k}" for k in range(40))] * 60 + [None, "", " "]
    got = {r["doc_id"]: r["text"] for r in periods.looped(table(spark, texts)).collect()}
    changed = 0
    for i, text in enumerate(texts):
        h, words = zlib.crc32(str(i).encode()), (text or "").split()
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[j if j < a else a + (j - a) % p] for j in range(n))
            changed += 1
        assert got[i] == text
    assert changed and periods.looped(table(spark, ["a b"], ids=[None])).first()["text"] == "a b"
