"""Language of a text by compression.

Each language has a Zstandard raw-content dictionary made of sample texts. A text is encoded
with every dictionary, whole, block by block; the language whose dictionary leaves the fewest
bytes wins. Where the next one is close, both are encoded again with more effort, and where it
is still almost as small, the prediction is marked as narrow.
"""
from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from msgledger.llm.common import small_batches, worker_cache

SAMPLE_DOCS = 200  # labelled texts per language
SAMPLE_CHARS = 4000  # characters taken from each of them
DICTIONARY_BYTES = 128 * 1024
TOTAL_BYTES = 64 * 1024 * 1024  # of all dictionaries; more languages get smaller ones
BLOCK = 2048
LEVELS = (3, 12)  # the second where the first leaves a margin below CLOSE
CLOSE = 0.05
NARROW = 0.01
UNKNOWN = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")
RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


def plain(text: str) -> bytes:
    """Lower-case words of letters only, so that case, digits and signs do not decide."""
    return NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """Dictionaries by language from columns text and lang, the language with most rows first.

    The sample is bounded: the ``sample_docs`` texts of a language with the smallest hashes of
    their text, ``sample_chars`` characters of each. Only hashes are ranked, and of a language only
    those below a cut that leaves some eight times as many as are wanted, so a frequent language
    costs no more than a rare one. Rows without text or lang teach nothing.
    """
    rows = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        "lang", F.xxhash64("text").alias("h"), F.substring("text", 1, sample_chars).alias("sample"))
    # One row per language, whose dictionaries the driver holds as well.
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("h").alias("distinct")).collect()
    if not counts:
        return {}
    cuts = rows.sparkSession.createDataFrame(
        [(r["lang"], int(min(1, 8 * sample_docs / r["distinct"]) * (2**64 - 2**12)) - 2**63) for r in counts], "lang string, cut long")
    below = rows.join(F.broadcast(cuts), "lang").where(F.col("h") <= F.col("cut"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    least = below.select("lang", "h").distinct().withColumn("rank", rank).where(F.col("rank") <= sample_docs).select("lang", "h")
    # At most ``sample_docs`` rows of two numbers per language.
    texts = rows.join(F.broadcast(least), ["lang", "h"]).groupBy("lang", "h").agg(F.min("sample").alias("sample"))
    samples: dict[str, list[bytes]] = {r["lang"]: [] for r in sorted(counts, key=lambda r: (-r["n"], r["lang"]))}
    for r in texts.orderBy("lang", "h").toLocalIterator():
        samples[r["lang"]].append(plain(r["sample"]))
    size = min(DICTIONARY_BYTES, TOTAL_BYTES // max(len(samples), 1))
    return {lang: b" ".join(found)[:size] for lang, found in samples.items()}


class Classifier:
    """Compressors with their dictionaries digested once."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = list(dictionaries)
        self.by_level = []
        for level in LEVELS:
            compressors = []
            for content in dictionaries.values():
                held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                held.precompute_compress(level=level)
                compressors.append(zstandard.ZstdCompressor(
                    level=level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))
            self.by_level.append(compressors)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        data = plain(text)
        blocks = [data[k:k + BLOCK] for k in range(0, len(data), BLOCK)]
        for compressors in self.by_level:
            sizes = sorted((sum(len(c.compress(b)) for b in blocks), k) for k, c in enumerate(compressors))
            best, k = sizes[0]
            score = 1.0 if len(sizes) == 1 else 1 - best / sizes[1][0]
            if score >= CLOSE:
                break
        return self.names[k], score


def predicted(text: Column, dictionaries: dict[str, bytes]) -> Column:
    name = hashlib.sha256(repr(list(dictionaries.items())).encode()).hexdigest()

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        classifier = worker_cache(f"language:{name}", lambda: Classifier(dictionaries))
        got = [classifier.predict(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["lang", "score"])

    return run(text)


def predict(docs: DataFrame, dictionaries: dict[str, bytes], narrow: float = NARROW) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1: the share by which the next language is larger) and
    ``narrow`` (the margin is too small to rely on).

    Uses the text alone. Null, empty and letterless texts are ``und`` with score 0; so is
    everything if nothing was learned. Ties go to the language that was learned from more rows. Texts are whole.
    All columns pass through, an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    got = docs.withColumn("__language", predicted(F.col("text"), dictionaries))
    return got.select(*[got[c] for c in docs.columns], F.col("__language.lang").alias("lang_pred"),
                      F.col("__language.score").alias("score"),
                      (F.col("__language.score") < narrow).alias("narrow"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Remainder 2 of crc32 of the id's text by 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
