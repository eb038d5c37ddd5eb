"""The registered queries of this folder and their SQL; `pipeline` is in corpus_pipeline.py."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from msgledger.llm import language, license_scan, lines, mixing, periods, pieces, quality, repeats, secrets, simhash, spelling, token_counts, topk
from msgledger.llm.common import documents


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir), license_scan.template_table(spark))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(rows, rows.where("vec_id % 50 = 0"), 5)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(documents(spark, sf_dir))


def op5_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(documents(spark, sf_dir))


def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repeats.remove_repeats(documents(spark, sf_dir), keep_bytes=False)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("left").alias("kept_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc_id", "result.n_lines", "result.n_dropped", F.sha2("result.text", 256).alias("kept_sha256"))


def op8_piece_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.summary(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", language.held_out().alias("held_out"))
    learned = language.fit(docs.where(~F.col("held_out")))
    return language.predict(docs.select("doc_id", "text", "held_out"), learned).drop("text")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(documents(spark, sf_dir)))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = documents(spark, sf_dir).select("doc_id", F.explode(spelling.words_of(F.col("text"))).alias("word"))
    return spelling.variants(spelling.vocabulary(spelling.slipped(found)))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.with_best(periods.periodic_runs(periods.looped(documents(spark, sf_dir)), keep_text=False))
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_license_scan": op2_license_scan,
    "op3_exact_topk": op3_exact_topk,
    "op4_source_mixing": op4_source_mixing,
    "op5_simhash_neardup": op5_simhash_neardup,
    "op6_repeated_strings": op6_repeated_strings,
    "op7_line_dedup": op7_line_dedup,
    "op8_piece_segmentation": op8_piece_segmentation,
    "op9_token_counts": op9_token_counts,
    "op10_language_id": op10_language_id,
    "op11_secret_scan": op11_secret_scan,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_periodic_runs": op13_periodic_runs,
}

_NOTICES = ", ".join(f"('{name}', '{text}')" for name, text in license_scan.TEMPLATES.items())

# crc32 of a text, byte by byte; the table is made from its rule.
_CRC = """
crc_table AS (SELECT list(c ORDER BY i) AS crc FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i)))"""


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text's UTF-8; needs ``crc`` of ``crc_table`` in scope."""
    byte = f"('0x' || substr(hex(encode({text})), (2 * k + 1)::INT, 2))::BIGINT"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode({text}))), "
            f"lambda k: {byte})), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])))")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(place: int, kind: str, pattern: str, group: int = 0) -> str:
    p = _quoted(pattern)
    return (f"SELECT doc_id, {place} AS place, '{kind}' AS kind, regexp_extract_all(t, {p}) AS ms, regexp_extract_all(t, {p}, {group}) AS vs, "
            f"string_split_regex(t, {p}) AS gaps FROM d")


_KINDS = " UNION ALL ".join([
    _matches(0, "assign", secrets.ASSIGN, 2), _matches(1, "access", "AKIA[A-Z0-9]+"), _matches(2, "hex", "[0-9a-f]+"),
    *(_matches(k, c.kind, f"[{c.chars}]+") for k, c in enumerate(secrets.CLASSES, 3))])
_CLASSES = ", ".join(f"({k}, {c.window}, {c.limit}, {c.weights})" for k, c in enumerate(secrets.CLASSES, 3))


ORACLES: dict[str, str] = {
    "op1_quality_rules": r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d),
windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM starts),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines
        WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        coalesce(n_symbols * 10000 // nullif(word_chars, 0), 0) AS symbol_share,
        coalesce(word_chars * 100 // nullif(n_words, 0), 0) AS word_length,
        coalesce(n_dup_lines * 10000 // nullif(n_words, 0), 0) AS dup_line_share,
        coalesce(n_repeat_words * 10000 // nullif(n_words, 0), 0) AS repeat_share FROM c),
long AS (
  SELECT lang, source, 'symbol_share' AS k, symbol_share AS v FROM m WHERE NOT base_failed UNION ALL
  SELECT lang, source, 'word_length', word_length FROM m WHERE NOT base_failed UNION ALL
  SELECT lang, source, 'dup_line_share', dup_line_share FROM m WHERE NOT base_failed UNION ALL
  SELECT lang, source, 'repeat_share', repeat_share FROM m WHERE NOT base_failed),
bins AS (SELECT lang, source, k, (v >> e) << e AS b, count(*) AS n FROM
           (SELECT *, greatest(length(bin(v)) - 6, 0) AS e FROM long) GROUP BY ALL),
by_lang AS (SELECT lang, k, b, sum(n) AS n FROM bins GROUP BY ALL),
lent AS (SELECT lang, k, b, 50000000 * n // sum(n) OVER (PARTITION BY lang, k) AS w FROM by_lang),
both_ AS (SELECT lang, source, k, b, 1000000 * n AS w FROM bins UNION ALL
          SELECT g.lang, g.source, g.k, b, w FROM (SELECT DISTINCT lang, source, k FROM bins) g
            JOIN lent ON g.lang IS NOT DISTINCT FROM lent.lang AND g.k = lent.k),
sketch AS (SELECT lang, source, k, b, sum(w) AS w FROM both_ GROUP BY ALL),
seen AS (SELECT *, sum(w) OVER (PARTITION BY lang, source, k ORDER BY b) AS upto, sum(w) OVER (PARTITION BY lang, source, k) AS total FROM sketch),
q AS (SELECT lang, source, k, min(b) FILTER (4 * upto >= total) AS q1, min(b) FILTER (4 * upto >= 2 * total) AS q2,
        min(b) FILTER (4 * upto >= 3 * total) AS q3 FROM seen GROUP BY ALL),
votes AS (SELECT lang, k, q2 AS b, count(*) AS w FROM q GROUP BY ALL),
voted AS (SELECT *, sum(w) OVER (PARTITION BY lang, k ORDER BY b) AS upto, sum(w) OVER (PARTITION BY lang, k) AS total FROM votes),
v AS (SELECT lang, k, min(b) FILTER (4 * upto >= total) AS m1, min(b) FILTER (4 * upto >= 2 * total) AS m2,
        min(b) FILTER (4 * upto >= 3 * total) AS m3 FROM voted GROUP BY ALL),
t AS (SELECT q.lang, q.source,
        max(CASE WHEN q.k = 'symbol_share' THEN least(q3 + 3 * (q3 - q2) + 500, greatest(m3 + 3 * (m3 - m2), q2) + 1000) END) AS hi_symbol,
        max(CASE WHEN q.k = 'word_length' THEN least(q3 + 4 * (q3 - q2) + 200, greatest(m3 + 4 * (m3 - m2), q2) + 400) END) AS hi_length,
        max(CASE WHEN q.k = 'word_length' THEN greatest(q1 - 4 * (q2 - q1) - 200, least(m1 - 4 * (m2 - m1), q2) - 400) END) AS lo_length,
        max(CASE WHEN q.k = 'dup_line_share' THEN least(q3 + 3 * (q3 - q2) + 400, greatest(m3 + 3 * (m3 - m2), q2) + 800) END) AS hi_dup,
        max(CASE WHEN q.k = 'repeat_share' THEN least(q3 + 3 * (q3 - q2) + 3500, greatest(m3 + 3 * (m3 - m2), q2) + 4200) END) AS hi_repeat
      FROM q JOIN v ON q.lang IS NOT DISTINCT FROM v.lang AND q.k = v.k GROUP BY q.lang, q.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND symbol_share <= coalesce(hi_symbol, symbol_share)
    AND word_length <= coalesce(hi_length, word_length) AND word_length >= coalesce(lo_length, word_length)
    AND dup_line_share <= coalesce(hi_dup, dup_line_share) AND repeat_share <= coalesce(hi_repeat, repeat_share) AS kept
FROM m LEFT JOIN t ON m.lang IS NOT DISTINCT FROM t.lang AND m.source IS NOT DISTINCT FROM t.source
""",
    "op2_license_scan": rf"""
WITH n AS (SELECT * FROM (VALUES {_NOTICES}) v(template, text)),
tw AS (SELECT template, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM n),
ts AS (SELECT template, w, len(w) - 4 AS size, unnest(range(1, len(w) - 3)) AS i FROM tw),
t AS (SELECT DISTINCT template, size, array_to_string(w[i:i + 4], ' ') AS g FROM ts),
c AS (SELECT template, count(*) AS total, (CASE WHEN any_value(size) = 1 THEN 1 ELSE 1 << length(bin(any_value(size) - 1)) END)::BIGINT AS span
      FROM t GROUP BY template),
dw AS (SELECT doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents),
ds AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM dw),
d AS (SELECT doc_id, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS g FROM ds),
m AS (SELECT doc_id, template, g, total, span, unnest([pos // span, greatest(pos // span - 1, 0)]) AS k
      FROM d JOIN t USING (g) JOIN c USING (template)),
x AS (SELECT doc_id, template, k * span AS first, count(DISTINCT g) / any_value(total) AS share
      FROM m GROUP BY doc_id, template, k, span)
SELECT doc_id, template, max(share) AS containment, min(first)::BIGINT AS first_word
FROM x WHERE share >= 0.8 GROUP BY doc_id, template
""",
    "op3_exact_topk": r"""
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum([z[1] * z[2] FOR z IN list_zip(q.e, c.e)])::BIGINT AS score
      FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op4_source_mixing": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             ('0x' || substr(md5('mix-1|' || coalesce(source, '\N') || '|' || doc_id), 1, 15))::BIGINT AS u FROM documents),
b0 AS (SELECT *, u >> 50 AS block FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
        row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
f AS (SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / weight, place) AS rn,
        (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM w),
l AS (SELECT min_by(level, rn) AS level FROM f WHERE level * weight < cap),
t AS (SELECT source, source_size, least(cap::DOUBLE, coalesce((SELECT level FROM l) * weight, cap::DOUBLE)) AS target FROM f),
blocks AS (SELECT source, block, sum(size)::BIGINT AS words,
             ('0x' || substr(md5('mix-1|block|' || coalesce(source, '\N') || '|' || block), 1, 15))::BIGINT AS drawn
           FROM b0 GROUP BY source, block),
q AS (SELECT b.*, floor(target)::BIGINT // source_size AS passes, floor(target)::BIGINT % source_size AS rest,
        sum(words) OVER (PARTITION BY b.source ORDER BY drawn, block) - words AS before
      FROM blocks b JOIN t ON b.source IS NOT DISTINCT FROM t.source WHERE source_size > 0),
r AS (SELECT *, greatest(least(rest - before, words), 0)::BIGINT AS room FROM q),
x AS (SELECT doc_id, b0.source, size, passes, room, words,
        sum(size) OVER (PARTITION BY b0.source, b0.block ORDER BY u, doc_id) - size AS ahead
      FROM b0 LEFT JOIN r ON b0.source IS NOT DISTINCT FROM r.source AND b0.block = r.block)
SELECT doc_id, size, source_size, target, coalesce(passes * size
    + CASE WHEN room = words THEN size ELSE greatest(least(room - ahead, size), 0) END, 0)::BIGINT AS taken
FROM x JOIN t ON x.source IS NOT DISTINCT FROM t.source
""",
    "op7_line_dedup": r"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM cut),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
shared AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
           GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT doc_id, line, pos, keeper IS NOT NULL AND keeper <> doc_id AS lost FROM k LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM j GROUP BY doc_id
""",
    "op11_secret_scan": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS ({_KINDS}),
u AS (SELECT doc_id, place, kind, unnest(range(len(ms))) AS i, unnest(ms) AS m, unnest(vs) AS v, unnest(gaps[1:len(ms)]) AS g FROM k),
p AS (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY doc_id, place ORDER BY i) AS e FROM u),
base AS (SELECT doc_id, place, kind, e - length(m) AS s, e FROM p
         WHERE (place = 0 AND length(v) >= 12) OR (place = 1 AND length(m) >= 18) OR (place = 2 AND length(m) >= 16)),
c AS (SELECT * FROM (VALUES {_CLASSES}) v(place, w, most, weights)),
r AS (SELECT doc_id, place, kind, e - length(m) AS s, m, w, most, weights FROM p JOIN c USING (place)
      WHERE length(m) >= w AND NOT regexp_full_match(m, {_quoted("|".join(secrets.ALLOWED))})),
win AS (SELECT *, unnest(range(length(m) - w + 1)) AS i FROM r),
ch AS (SELECT doc_id, place, kind, s, i, w, most, weights, unnest(string_split(substr(m, i + 1, w), '')) AS x FROM win),
n AS (SELECT doc_id, place, kind, s, i, w, most, weights, x, count(*) AS n FROM ch GROUP BY ALL),
hit AS (SELECT doc_id, place, kind, s, i, w FROM n GROUP BY doc_id, place, kind, s, i, w, most HAVING sum(weights[n + 1]) <= most),
new AS (SELECT *, coalesce(i - lag(i) OVER (PARTITION BY doc_id, place, s ORDER BY i) > w, true)::INT AS new FROM hit),
isl AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, place, s ORDER BY i) AS g FROM new),
more AS (SELECT doc_id, place, kind, s + min(i) AS s, s + max(i) + max(w) AS e FROM isl GROUP BY doc_id, place, kind, s, g),
spans AS (SELECT *, kind || ':' || s::BIGINT || ':' || e::BIGINT AS t FROM (FROM base UNION ALL FROM more)),
by_doc AS (SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
             string_agg(t, ',' ORDER BY s, place) FILTER (place < 3) AS base, string_agg(t, ',' ORDER BY s, place) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN by_doc USING (doc_id)
""",
    "op12_spelling_variants": rf"""
WITH RECURSIVE {_CRC},
r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
c AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY doc_id, run),
h AS (SELECT *, {_crc32("doc_id || ':' || run")} AS h FROM c, crc_table),
s AS (SELECT n, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM s WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS t FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.t = b.t AND a.i = b.i AND a.word <> b.word UNION
  SELECT a.word, a.n, v.word, v.n FROM cut a JOIN v ON a.t = v.word UNION
  SELECT v.word, v.n, a.word, a.n FROM cut a JOIN v ON a.t = v.word),
best AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
         QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form,
        CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n FROM v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS tip FROM f UNION ALL
          SELECT chain.word, f.form FROM chain JOIN f ON chain.tip = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, tip AS root, f.n, f.n_near, f.form_n
FROM f JOIN chain USING (word) JOIN f AS last ON last.word = tip AND last.form IS NULL
""",
    "op13_periodic_runs": rf"""
WITH {_CRC},
d0 AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_crc32("doc_id::VARCHAR")} AS h
       FROM documents, crc_table),
d1 AS (SELECT *, len(w) AS n, h // 10 AS g FROM d0),
d2 AS (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM d1),
d3 AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM d2),
d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1])
        ELSE w END AS w FROM d3),
-- A run repeats 16 words or more one period on, so two of its 16-word stretches are equal.
starts AS (SELECT doc_id, w, unnest(range(n - 15)) AS i FROM d WHERE n >= 24),
grams AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 16], ' ') AS t FROM starts),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.t = y.t AND y.i > x.i),
island AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pairs),
run AS (SELECT doc_id, min(i) AS start, count(*) + 15 + q AS length, q AS period FROM island GROUP BY doc_id, q, k
        HAVING count(*) + 15 + q >= greatest(24, 3 * q)),
runs AS (SELECT doc_id, start, length, min(period) AS period FROM run GROUP BY doc_id, start, length),
best AS (SELECT r.* FROM runs r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DECIMAL(38, 18) / period DESC, start, period) = 1),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t
           FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM d),
left_ AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(left_.t, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN left_ USING (doc_id)
""",
}
