"""Group spelling variants: words that one inserted, deleted or replaced character parts.

1. Occurrences are counted to a vocabulary, with map-side combine.
2. Each word length has a blocked Bloom filter: a word sets two bits in each of the four longs of
   one block. Tasks make masks, a shuffle of (block, mask) merges them.
3. Filters are broadcast. Every word's edits are made and probed: all deletions, and replacements by
   smaller characters of the alphabet. A pair of near words is met once so, from the longer or the
   larger; an insertion is the other word's deletion. Hashes of edits follow from running sums, so
   an edit that the filter denies is never spelled out.
4. Only what a filter lets through is shuffled, to a join with the vocabulary, which removes what it let
   through wrongly.

Filters of more than PASS_BYTES are broadcast in several passes, each over a range of blocks.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from msgledger.llm.common import map_arrow, stage_table

# The letters of runs of [A-Za-zÀ-ÿ] once A-Z are lower case.
ALPHABET = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
MIN_LENGTH, MIN_COUNT, TIMES = 7, 2, 10
LONG = 64  # words of this length and more share a filter
WORDS_A_BLOCK = 16  # of 256 bits
PASS_BYTES = 16 << 20  # broadcast at once
EDITS_AT = 20_000  # places of words whose edits are made together
U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(29))) * U(0x9FB21C651E98DF25)
    return x ^ (x >> U(32))


class Shards(NamedTuple):
    """Blocks of each length's filter: the first one's number, and how many."""

    first: np.ndarray
    blocks: np.ndarray

    @classmethod
    def of(cls, words: dict[int, int]) -> Shards:
        blocks = np.array([-(-words.get(n, 0) // WORDS_A_BLOCK) for n in range(LONG + 1)], np.uint64)
        return cls(np.cumsum(blocks) - blocks, blocks)

    def place(self, length: int, h: np.ndarray) -> np.ndarray:
        n = min(length, LONG)
        return self.first[n] + (((h >> U(32)) * self.blocks[n]) >> U(32))


def _lane(h: np.ndarray, lane: int) -> np.ndarray:
    """Two bits for one of a block's four longs."""
    h = h * U(0xA0761D6478BD642F)
    return (U(1) << ((h >> U(12 * lane)) & U(63))) | (U(1) << ((h >> U(12 * lane + 6)) & U(63)))


class Speller:
    """Words as numbers, their hashes and those of their edits."""

    def __init__(self, alphabet: str):
        self.alphabet = "".join(sorted(set(alphabet)))
        self.code = np.full(max(map(ord, self.alphabet)) + 2, -1, np.int64)
        self.code[[ord(c) for c in self.alphabet]] = np.arange(len(self.alphabet))
        self.value = _mix(np.arange(1, len(self.alphabet) + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))

    def groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Which words, and their characters' numbers in rows, by length; others' characters leave a word out."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.code[np.minimum(flat, len(self.code) - 1)]
        begin = np.cumsum(sizes) - sizes
        for n in np.unique(sizes[sizes > 0]).tolist():
            which = np.flatnonzero(sizes == n)
            rows = codes[begin[which][:, None] + np.arange(n)]
            known = (rows >= 0).all(axis=1)
            yield which[known], rows[known]

    def sums(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Powers, the terms of each place, and the hash before mixing of each row."""
        power = np.full(rows.shape[1] + 1, 0xC6BC279692B5CC83, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        terms = self.value[rows] * power[:-1]
        return power, terms, terms.sum(axis=1, dtype=np.uint64)

    def edits(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, row, place, new character, hash) of deletions (character -1) and replacements by smaller ones."""
        n = rows.shape[1]
        power, terms, whole = self.sums(rows)
        if n > 1:
            shifted = self.value[rows] * np.concatenate((power[:1], power[:n - 1]))
            shifted[:, 0] = 0
            after = shifted.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(shifted, axis=1, dtype=np.uint64)
            without = np.cumsum(terms, axis=1, dtype=np.uint64) - terms + after
            # Of equal neighbours only the first one's deletion is a new word.
            new = np.ones(rows.shape, bool)
            new[:, 1:] = rows[:, 1:] != rows[:, :-1]
            row, place = np.nonzero(new)
            yield n - 1, row, place, np.full(len(row), -1), _mix(without[row, place] + U(n - 1))
        flat, step = rows.ravel(), EDITS_AT
        base = (whole[:, None] - terms).ravel()
        for a in range(0, len(flat), step):
            counts = flat[a:a + step]
            at = np.repeat(np.arange(a, a + len(counts)), counts)
            char = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
            yield n, at // n, at % n, char, _mix(base[at] + self.value[char] * power[at % n] + U(n))


def words_of(text: Column, min_length: int = MIN_LENGTH) -> Column:
    """Maximal runs of [A-Za-z\\u00C0-\\u00FF] of at least ``min_length`` characters, A-Z lower-cased."""
    # A run too short never matches, and a long one matches whole.
    runs = F.regexp_extract_all(text, F.lit(r"[A-Za-zÀ-ÿ]{%d,}" % min_length), F.lit(0))
    return F.transform(runs, lambda w: F.translate(w, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def slipped(words: DataFrame) -> DataFrame:
    """``words`` (doc_id, word) where one in 31, by h = crc32 of ``<doc_id>:<word>``, lacks its character
    h % length. A null doc_id slips nothing."""
    h = F.crc32(F.concat_ws(":", F.col("doc_id").cast("string"), "word").cast("binary"))
    rows = words.withColumn("h", F.when(F.col("doc_id").isNotNull(), h))
    cut = F.expr("concat(substring(word, 1, int(h % length(word))), substring(word, int(h % length(word)) + 2))")
    return rows.withColumn("word", F.when((F.col("h") % 31 == 0) & (F.length("word") > 0), cut).otherwise(F.col("word"))).drop("h")


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of ``words`` (word; a row for each occurrence) long and frequent enough."""
    counted = words.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
    # By a fixed number, so that probing is spread however few bytes the words take.
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage_table(counted.repartition(parts, "word"), "spelling-vocabulary")


def _filter(words: DataFrame, speller: Speller, shards: Shards, low: int, high: int) -> np.ndarray:
    """Blocks ``low`` to ``high`` of the filters, a row of four longs each; at most PASS_BYTES."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for _, rows in speller.groups(batch.column(0).to_pylist()):
            h = _mix(speller.sums(rows)[2] + U(rows.shape[1]))
            place = shards.place(rows.shape[1], h).astype(np.int64)
            here = np.flatnonzero((place >= low) & (place < high))
            here = here[np.argsort(place[here])]
            if len(here):
                at = place[here]
                starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
                masks = [np.bitwise_or.reduceat(_lane(h[here], k), starts).view(np.int64) for k in range(4)]
                yield pa.RecordBatch.from_arrays([pa.array(at[starts]), *map(pa.array, masks)], ["block", "m0", "m1", "m2", "m3"])

    masks = map_arrow(words.select("word"), run, "block long, m0 long, m1 long, m2 long, m3 long")
    found = masks.groupBy("block").agg(*[F.bit_or(f"m{k}").alias(f"m{k}") for k in range(4)]).toArrow()
    out = np.zeros((high - low, 4), np.uint64)
    out[found.column("block").to_numpy() - low] = np.stack([found.column(f"m{k}").to_numpy() for k in range(4)], axis=1).view(np.uint64)
    return out


def _positives(words: DataFrame, speller: Speller, shards: Shards, low: int, high: int) -> DataFrame:
    """(word, n, near) of the edits that a pass's filters let through."""
    spark = words.sparkSession
    held = spark.sparkContext.broadcast(_filter(words, speller, shards, low, high))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bloom, words = held.value, batch.column(0).to_pylist()
        which, near = [], []
        for index, rows in speller.groups(words):
            for n, row, place, char, h in speller.edits(rows):
                if not shards.blocks[min(n, LONG)]:
                    continue
                block = shards.place(n, h).astype(np.int64)
                maybe = np.flatnonzero((block >= low) & (block < high))
                for lane in range(4):
                    mask = _lane(h[maybe], lane)
                    maybe = maybe[bloom[block[maybe] - low, lane] & mask == mask]
                for k, at, c in zip(index[row[maybe]].tolist(), place[maybe].tolist(), char[maybe].tolist(), strict=True):
                    which.append(k)
                    near.append(words[k][:at] + (speller.alphabet[c] if c >= 0 else "") + words[k][at + 1:])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which, pa.int64())), batch.column(1).take(pa.array(which, pa.int64())),
                                          pa.array(near, pa.string())], ["word", "n", "near"])

    found = stage_table(map_arrow(words, run, "word string, n long, near string"), "spelling-positives")
    held.destroy()
    return found


def near_pairs(words: DataFrame, alphabet: str = ALPHABET, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(word, n, near, near_n): each pair of ``words`` (word, n; distinct, staged) one edit apart, once."""
    speller = Speller(alphabet)
    lengths = words.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("k")).count().collect()  # 65 rows at most
    shards = Shards.of({r["k"]: r["count"] for r in lengths})
    total, step = int(shards.blocks.sum()), max(pass_bytes // 32, 1)
    passes = [_positives(words, speller, shards, a, min(a + step, total)) for a in range(0, total, step)]
    if not passes:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return reduce(DataFrame.unionByName, passes).join(known, "near").select("word", "n", "near", "near_n")


def variants(words: DataFrame, alphabet: str = ALPHABET, times: int = TIMES, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """word, form, root, n, n_near and form_n for every row of ``words`` (word, n), a vocabulary.

    Near words differ by one inserted, deleted or replaced character, all of ``alphabet``; a word with
    another character has no near words. A word's form is its most frequent near word (ties: the
    smallest) if that is ``times`` as frequent; root follows forms to the last. Words without a
    form are their own root, with null form and form_n. A null or empty word is near nothing. Words
    are whole, however long. Each word should come once: repeated rows are counted as near words of
    their own. Other columns are ignored; an empty table gives no rows.
    """
    words = words.select("word", F.col("n").cast("bigint").alias("n"))
    pairs = near_pairs(words.where("word IS NOT NULL"), alphabet, pass_bytes)
    both = pairs.select(F.explode(F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))).alias("p"))
    best = both.groupBy("p.word").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("p.near_n"), F.col("p.near"))).alias("best"))
    best = best.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.col1")).alias("form_n"))
    rows = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *[
        F.when(F.col("form_n") >= times * F.col("n"), F.col(c)).alias(c) for c in ("form", "form_n")])
    rows = stage_table(rows, "spelling-forms")
    roots = _roots(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain. Counts grow by ``times`` with every link, so chains
    are short; each round doubles what a link spans."""
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        done = stage_table(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "spelling-roots")
        if done.where("next IS NOT NULL").isEmpty():
            return done.select("word", "root")
        links = done.select("word", "root")
