"""Quality rules, line dedup, licences, token counts, pieces and languages on small inputs."""
import hashlib
import random
import zlib

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from msgledger.llm import language, license_scan, lines, pieces, quality, token_counts
from msgledger.llm.common import documents
from msgledger.llm.vocab import load

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n\n", "a", "é" * 30, "日本語 テキスト", "x" * 5000, "a b\tc\x0bd\x0ce\rf", "word " * 3000, "\x00 \x1f", " a "]
WIDE = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept boolean, size long, h binary, fp long"


def table(spark, texts, lang="en", source="s", start=0):
    return spark.createDataFrame([(start + i, t, lang, source, 7, 7, None, 7, b"x", 1) for i, t in enumerate(texts)], WIDE)


# Quality rules.

def slow_counts(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


@pytest.mark.parametrize("text", [*ODD[:9], "a b c a b c", "one\none\n \n \ntwo one", "# * | <x>", "a a a a a"])
def test_counts(text):
    assert quality.counts_of(text) == slow_counts(text)


def test_quality_keeps_prose_and_drops_outliers(spark):
    rng = random.Random(1)
    prose = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"]) + str(rng.randrange(500))
                      for _ in range(rng.randint(60, 200))) for _ in range(300)]
    junk = [" ".join(f"{w}###" for w in p.split()) for p in prose[:10]]
    got = {r["doc_id"]: r for r in quality.score(table(spark, prose + junk)).collect()}
    assert all(got[i]["kept"] for i in range(300))
    assert not any(got[i]["kept"] or got[i]["base_failed"] for i in range(300, 310))


def test_quality_odd_rows(spark):
    docs = table(spark, ODD + ODD, lang=None, source=None)
    rows = quality.score(docs).collect()
    assert len(rows) == 2 * len(ODD) and not any(r["kept"] for r in rows)
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.score(docs.limit(0)).count() == 0 == quality.keep_good(docs.limit(0)).count()


def test_quality_filter_agrees_with_scores(spark):
    docs = documents(spark, SF)
    want = {r[0] for r in quality.score(docs).where("kept").select("doc_id").collect()}
    assert {r[0] for r in quality.keep_good(docs).select("doc_id").collect()} == want


def test_small_groups_use_merged_sketches(spark):
    rows = spark.createDataFrame([("en", f"s{i % 5}", "word_length", 400 + i % 7, 1) for i in range(100)],
                                 "lang string, source string, measure string, bin long, n long")
    limits = quality.thresholds(rows, min_rows=50).collect()
    assert len(limits) == 5 and len({r["hi_word_length"] for r in limits}) == 1


@pytest.mark.parametrize(("share", "spoil"), [(15, "{}###"), (30, "{}###"), (30, "{}\nas above\n")])
def test_junk_in_a_group_does_not_move_its_fences(spark, share, spoil):
    rng = random.Random(21)
    prose = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta"]) + str(rng.randrange(500))
                      for _ in range(rng.randint(60, 90))) for _ in range(100)]
    docs = table(spark, [" ".join(map(spoil.format, p.split())) if i < share else p for i, p in enumerate(prose)])
    many = docs.crossJoin(spark.range(100).select(F.col("id").alias("again")))
    for rows in (docs, many):
        kept = quality.score(rows).where("kept").groupBy("doc_id").count().collect()
        assert {r["doc_id"]: r["count"] for r in kept} == dict.fromkeys(range(share, 100), rows.count() // 100)


def prose_of(rng, words, n):
    return [" ".join(rng.choice(words) + str(rng.randrange(500)) for _ in range(rng.randint(60, 90))) for _ in range(n)]


@pytest.mark.parametrize("n", [100, 199, 200, 1000])
def test_size_is_no_switch(spark, n):
    """A source with a style of its own beside a large plain one, and one with junk in three rows of ten."""
    rng = random.Random(n)
    plain = prose_of(rng, ["alpha", "beta", "gamma", "delta"], 1500)
    longer = prose_of(rng, ["internationalisation", "misunderstandings", "characteristically"], n)
    dirty = [" ".join(w + "###" for w in t.split()) if i % 10 < 3 else t for i, t in enumerate(prose_of(rng, ["alpha", "beta", "gamma"], n))]
    docs = table(spark, plain, source="a").unionByName(table(spark, longer, source="b", start=5000)).unionByName(table(spark, dirty, source="c", start=9000))
    kept = {r["doc_id"] for r in quality.score(docs).where("kept").collect()}
    assert kept == {*range(1500), *range(5000, 5000 + n), *(9000 + i for i in range(n) if i % 10 >= 3)}


def test_light_use_of_symbols_is_a_style(spark):
    rng = random.Random(31)
    docs = [t if i % 20 < 11 else " ".join(w + ("#" if k % 12 == 0 else "") for k, w in enumerate(t.split()))
            for i, t in enumerate(prose_of(rng, ["alpha", "beta", "gamma"], 400))]
    assert quality.score(table(spark, docs)).where("kept").count() == 400


def slow_limits(rows, add):
    """(lang, source) -> limits, straight from the rows' binned measures."""
    def binned(v):
        e = max(v.bit_length() - 6, 0) if v else 0
        return v >> e << e

    def quartiles(weights):
        total, out = sum(weights.values()), []
        for k in (1, 2, 3):
            upto = 0
            for b in sorted(weights):
                upto += weights[b]
                if 4 * upto >= k * total:
                    out.append(b)
                    break
        return out

    own, lang = {}, {}
    for (la, so), values in rows:
        for m, v in values.items():
            for held, key in ((own, (la, so, m)), (lang, (la, m))):
                held.setdefault(key, {}).setdefault(binned(v), 0)
                held[key][binned(v)] += 1
    q, votes = {}, {}
    for (la, so, m), sketch in own.items():
        whole = lang[la, m]
        mixed = {b: n * 1_000_000 for b, n in sketch.items()}
        for b, n in whole.items():
            mixed[b] = mixed.get(b, 0) + add * 1_000_000 * n // sum(whole.values())
        q[la, so, m] = quartiles(mixed)
        votes.setdefault((la, m), {}).setdefault(q[la, so, m][1], 0)
        votes[la, m][q[la, so, m][1]] += 1
    out = {}
    for (la, so, m), (q1, q2, q3) in q.items():
        f, (m1, m2, m3) = quality.FENCES[m], quartiles(votes[la, m])
        limits = out.setdefault((la, so), {})
        limits[f"hi_{m}"] = min(q3 + f.spread * (q3 - q2) + f.slack, max(m3 + f.spread * (m3 - m2), q2) + f.most)
        if f.lower:
            limits[f"lo_{m}"] = max(q1 - f.spread * (q2 - q1) - f.slack, min(m1 - f.spread * (m2 - m1), q2) - f.most)
    return out


def test_limits_equal_plain_version(spark):
    rng = random.Random(41)
    rows = [((rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None])), {m: int(rng.paretovariate(0.7) * rng.choice([0, 1, 40])) for m in quality.FENCES})
            for _ in range(600)]
    df = spark.createDataFrame([(*k, *v.values()) for k, v in rows], "lang string, source string, " + ", ".join(f"{m} long" for m in quality.FENCES))
    got = {(r["t_lang"], r["t_source"]): {c: r[c] for c in r.asDict() if c[:2] in ("hi", "lo")} for r in quality.thresholds(quality.sketches(df), 50).collect()}
    assert got == slow_limits(rows, 50)


# Line dedup.

def slow_lines(rows):
    blank = " \t\n\x0b\x0c\r"
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            key = x.strip(blank).translate(low)
            if len(key) >= 20:
                held.setdefault(key, set()).add(d)
    out = []
    for d, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if len(s := held.get(x.strip(blank).translate(low), ())) < 3 or max(s) == d]
        out.append((d, len(every), len(every) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def test_lines(spark):
    rng = random.Random(2)
    pool = ["Shared line number one, long enough", "  shared LINE number one, long enough\t", "é" * 20, "É" * 20, "é" * 19,
            "unique", "", " ", "another line that is long enough  ", "x" * 20, "X" * 20]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 8))) for _ in range(60)] + ODD
    docs = table(spark, texts)
    got = lines.dedup_lines(docs)
    assert got.columns == [*docs.columns, "result"]
    got = got.select("doc_id", "result.n_lines", "result.n_dropped", F.sha2("result.text", 256)).collect()
    assert sorted(tuple(r) for r in got) == slow_lines(list(enumerate(texts)))


def test_lines_repeated_and_null_ids(spark):
    line = "a line that several rows have in common"
    docs = spark.createDataFrame([(1, line), (1, line), (2, line), (None, line)], "doc_id long, text string")
    assert [r["result"]["n_dropped"] for r in lines.dedup_lines(docs).collect()] == [0] * 4
    docs = docs.union(spark.createDataFrame([(3, line)], "doc_id long, text string"))
    got = sorted((r["doc_id"] or 0, r["result"]["n_dropped"]) for r in lines.dedup_lines(docs).collect())
    assert got == [(0, 1), (1, 1), (1, 1), (2, 1), (3, 0)]
    assert lines.dedup_lines(docs.limit(0)).count() == 0


# Licences.

def test_licenses(spark):
    rng = random.Random(3)
    filler = ["lorem", "ipsum", "dolor", "sit", "amet"]
    texts, want = [], set()
    for i, (name, text) in enumerate(license_scan.TEMPLATES.items()):
        for j, at in enumerate((0, 1, 17, 400)):
            words = [rng.choice(filler) + str(rng.randrange(99)) for _ in range(500)]
            texts.append(" ".join(words[:at]) + " " + text.upper().replace(" ", " \n ") + " " + " ".join(words[at:]))
            want.add((4 * i + j, name))
    got = license_scan.scan(table(spark, texts), license_scan.template_table(spark)).collect()
    assert {(r["doc_id"], r["template"]) for r in got} == want
    assert all(r["containment"] == 1 for r in got)


def test_license_partial_and_odd_rows(spark):
    notice = license_scan.TEMPLATES["mit-permission"].split()
    nearly, half = " ".join(notice[:-2]), " ".join(notice[:9])
    templates = license_scan.template_table(spark, {"mit-permission": " ".join(notice), "short": "all rights reserved"})
    docs = table(spark, [nearly, half, *ODD])
    got = license_scan.scan(docs, templates).collect()
    assert [(r["doc_id"], r["template"]) for r in got] == [(0, "mit-permission")] and 0.8 <= got[0]["containment"] < 1
    assert license_scan.scan(docs.limit(0), templates).count() == 0 == license_scan.scan(docs, templates.limit(0)).count()


def test_license_plan_is_native(spark):
    plan = license_scan.scan(documents(spark, SF), license_scan.template_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# Token counts.

def test_token_counts_equal_the_library(spark):
    rng = random.Random(4)
    letters = "abcdetheinon ▁▁  \n\t.é日本<s>'😀​0123ἡ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(300)]
    texts += [*ODD, "ab" * 3000 + " x", " " * 500, "</s><unk> <0x0A>", "the" * 2000]
    texts += [r["text"] for r in documents(spark, SF).collect()]
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = sorted(tuple(r) for r in token_counts.token_counts(table(spark, texts), MODEL, limit=500).collect())
    sizes = [len(model.encode(t or "")) for t in texts]
    assert got == [(i, len((t or "").encode()), n, n > 500) for i, (t, n) in enumerate(zip(texts, sizes, strict=True))]
    assert token_counts.token_counts(table(spark, ["a"]).limit(0), MODEL).count() == 0


def test_long_runs_merge_alike():
    merger = token_counts.Merger(load(MODEL))
    rng = random.Random(5)
    ids = [merger.pieces.ids[c] for c in "aeinotsh"]
    for _ in range(50):
        run = [rng.choice(ids) for _ in range(rng.randint(2, 80))]
        assert merger.merge([run])[0] == merger.merge_long(run)


# Pieces.

def test_n_best_equals_brute_force():
    lattice = pieces.Lattice(load(MODEL))

    def every(token, start=0):
        if start == len(token):
            yield 0, ()
            return
        for end, score in lattice.arcs(token, start):
            for more, ids in every(token, end):
                yield score + more, (*lattice.ids_of(token[start:end]), *ids)

    rng = random.Random(6)
    for _ in range(150):
        text = "".join(rng.choice("abcdetheinon ▁  \n\t.é日𐍈") for _ in range(rng.randint(1, 8)))
        found = sorted(every("▁" + text.replace(" ", "▁")), key=lambda x: -x[0])
        ids, scores, others = lattice.segment([text], 4, others=True)[0]
        assert scores == [f[0] for f in found[:4]]
        got = list(zip(scores, [tuple(ids.tolist()), *map(tuple, others)], strict=True))
        assert len(set(got)) == len(got) and set(got) <= set(found)
        assert all(lattice.decode(g[1]) == text.replace("▁", " ") for g in got)


def test_pieces_round_trip(spark):
    texts = [*ODD, *[r["text"] for r in documents(spark, SF).collect()]]
    docs = table(spark, texts)
    got = pieces.summary(docs, MODEL).collect()
    assert len(got) == len(texts) and all(r["round_trip"] for r in got)
    assert all(r["scores"] == sorted(r["scores"], reverse=True) for r in got)
    assert {r["n_pieces"] for r in got if not texts[r["doc_id"]]} == {0}
    assert pieces.encode(docs, MODEL).columns == [*docs.columns, "encoded"]
    assert pieces.summary(docs.limit(0), MODEL).count() == 0


def test_every_segmentation_is_returned_and_decoded(spark):
    texts = ["the quick brown fox", "internationalisation of é things", "a", "", None]
    got = {r["doc_id"]: r for r in pieces.summary(table(spark, texts), MODEL).collect()}
    lattice = pieces.Lattice(load(MODEL))
    for i, s in enumerate(lattice.segment(texts, 4, others=True)):
        want = [hashlib.sha256(" ".join(map(str, ids.tolist())).encode()).hexdigest() for ids in (s.ids, *s.others)]
        assert [got[i]["ids_sha256"], *got[i]["others_sha256"]] == want
        assert len(set(want)) == max(len(s.scores), 1) and got[i]["n_segmentations"] == len(s.scores) and got[i]["round_trip"]
    assert got[0]["n_segmentations"] == 4


def test_forgetting_changes_nothing(monkeypatch):
    lattice = pieces.Lattice(load(MODEL))
    texts = ["the quick brown fox", "jumps over the dog", "and away it goes"]
    want = [(s.ids.tolist(), s.scores) for s in lattice.segment(texts, 3)]
    monkeypatch.setattr(pieces, "KNOWN", 2)
    assert [(s.ids.tolist(), s.scores) for t in texts for s in lattice.segment([t], 3)] == want


def test_what_sends_ids_back_stays_small(spark):
    texts = ["the quick brown fox", "internationalisation of é things", "a", "日本語", "", None]
    lean, full = pieces.Lattice(load(MODEL), digests=False), pieces.Lattice(load(MODEL))
    for a, b in zip(lean.segment(texts, 4, others=True), full.segment(texts, 4, others=True), strict=True):
        assert (a.ids.tolist(), a.scores, [o.tolist() for o in a.others]) == (b.ids.tolist(), b.scores, [o.tolist() for o in b.others])
    assert not lean.forms and len(full.forms) == len(full.known) == len(lean.known)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 400)
    pieces.encode(table(spark, texts), MODEL)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 100


# Languages.

def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01").select("doc_id", "text", "lang", language.held_out().alias("held_out"))
    ids = {r[0]: r[1] for r in docs.select("doc_id", "held_out").collect()}
    assert all(out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, out in ids.items())
    learned = language.fit(docs.where("not held_out"))
    got = language.predict(docs, learned).where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_rows(spark):
    learned = {"en": b"the and of to in that with for", "de": b"der die und das mit von ein"}
    texts = [*ODD, "123 456", "der die und das", "THE AND OF TO!"]
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(table(spark, texts), learned).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 10, 12)] == ["und"] * 6
    assert (got[13], got[14]) == ("de", "en")
    assert language.fit(table(spark, texts, lang=None)) == {}
    assert {r["lang_pred"] for r in language.predict(table(spark, texts), {}).collect()} == {"und"}
    assert language.predict(table(spark, texts).limit(0), learned).count() == 0
