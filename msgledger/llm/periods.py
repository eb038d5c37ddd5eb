"""Find runs of periodic words by recompression.

The words of many documents are turned into one run-length grammar: rounds of block compression
(equal neighbours become one symbol) and pair compression (symbols fall into two sides by a hash;
a left one followed by a right one becomes one symbol) until each document is a few symbols. Names
are given by sorting, so equal symbols are equal words. A longest-common-extension query climbs
from two words to the largest equal symbols that start there and comes down again at the first
difference; it takes logarithmic time and no suffix array.

A run of period q and length n holds n - q words that equal the one q further on, and n - q is at
least g = max(24 - q, 2 q), so the words at multiples of g hit every run. All (q, k g) form the
harmonic grid; those whose two words are equal are extended both ways by the grammar, which gives
the run's exact ends. Of equal stretches the smallest period counts.
"""
from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from msgledger.llm.common import map_arrow, small_batches, utf8

MIN_LENGTH = 24
MIN_REPEATS = 3
TOGETHER = 150_000  # words that share a grammar; a longer text has one of its own
GRID = 1_000_000  # places of the grid looked at together
SMALL = 4  # symbols at which a document is compressed enough
SCHEMA = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
          "collapsed binary, runs_sha256 string, collapsed_sha256 string")
U = np.uint64


class Grammar(NamedTuple):
    """Nodes of all levels, one level after the other; level 0 is the words. Symbol 0 is an edge of a
    document. ``parent`` and the children are -1 where there are none; ``ahead`` and ``behind``
    count the equal symbols from a node on, itself included."""

    symbol: np.ndarray
    size: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    last: np.ndarray
    ahead: np.ndarray
    behind: np.ndarray


def _sides(symbols: np.ndarray, step: int) -> np.ndarray:
    """Left or right, by a hash of the symbol that changes with the round."""
    x = (symbols.astype(U) + U(step << 40)) * U(0x9E3779B97F4A7C15)
    return ((x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9) >> U(63)).astype(bool)


def _name(names: int, keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Equal keys get equal names, after those given so far."""
    found, number = np.unique(keys, return_inverse=True)
    return number.reshape(-1) + names, names + len(found)


def grammar(words: np.ndarray) -> Grammar:
    """The grammar of ``words``: numbers from 1, with a 0 before, between and after documents."""
    names = int(words.max(initial=0)) + 1
    symbol, size = words.astype(np.int32), np.ones(len(words), np.int32)
    levels: list[tuple[np.ndarray, ...]] = []
    first = last = np.full(len(words), -1, np.int32)
    offset, step, paired = 0, 0, True
    while True:
        n = len(symbol)
        new = np.concatenate(([True], (symbol[1:] != symbol[:-1]) | (symbol[1:] == 0)))
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], n)
        place, sizes = np.arange(n), end - begin
        parent = np.full(n, -1, np.int32)
        levels.append((symbol, size, parent, first, last, (np.repeat(end, sizes) - place).astype(np.int32),
                       (place - np.repeat(begin, sizes) + 1).astype(np.int32)))
        # Documents of few symbols are done; an edge goes with the document before it.
        edge = symbol == 0
        doc = np.cumsum(edge) - edge
        busy = (np.bincount(doc[~edge], minlength=int(doc[-1]) + 1) > SMALL)[doc]
        if not busy.any():
            return Grammar(*map(np.concatenate, zip(*levels, strict=True)))
        busy[0] = True
        if paired and len(begin) < n:
            paired = False
            begin, end = begin[busy[begin]], end[busy[begin]]
            up, wide = symbol[begin].astype(np.int64), end - begin > 1
            up[wide], names = _name(names, (up[wide] << 32) | (end - begin)[wide])
            up_size = size[begin] * (end - begin)
        else:
            paired = True
            kept = np.flatnonzero(busy)
            here, right = symbol[kept].astype(np.int64), _sides(symbol[kept], step)
            pair = np.zeros(len(kept), bool)
            pair[:-1] = ~right[:-1] & right[1:] & (here[:-1] != 0) & (here[1:] != 0)
            heads = np.flatnonzero(~np.concatenate(([False], pair[:-1])))
            wide = pair[heads]
            begin = kept[heads]
            end = begin + 1 + wide
            up, up_size = here[heads], size[begin].copy()
            up[wide], names = _name(names, (up[wide] << 32) | here[heads[wide] + 1])
            up_size[wide] += size[begin[wide] + 1]
        # Children lie side by side.
        sizes = end - begin
        parent[np.repeat(begin, sizes) + _within(sizes)] = np.repeat(np.arange(len(begin)) + offset + n, sizes)
        symbol, size = up.astype(np.int32), up_size.astype(np.int32)
        first, last = (begin + offset).astype(np.int32), (end - 1 + offset).astype(np.int32)
        offset += n
        step += 1


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... in each of several stretches."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def extension(g: Grammar, x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from places x and y on (or back) are equal, inside their documents."""
    step, edge, equal = (1, g.first, g.ahead) if forward else (-1, g.last, g.behind)
    out = np.zeros(len(x), np.int64)
    x, y, who, climb = x.astype(np.int64), y.astype(np.int64), np.arange(len(x)), np.ones(len(x), bool)
    while len(x):
        left, right = g.symbol[x], g.symbol[y]
        inside = (left != 0) & (right != 0)
        same = inside & (left == right)
        up, over = g.parent[x], g.parent[y]
        rise = same & climb & (up >= 0) & (over >= 0)
        rise[rise] = (edge[up[rise]] == x[rise]) & (edge[over[rise]] == y[rise]) & (g.symbol[up[rise]] == g.symbol[over[rise]])
        go = same & ~rise
        by = np.minimum(equal[x[go]], equal[y[go]]).astype(np.int64)
        out[who[go]] += by * g.size[x[go]]
        fall = inside & ~same
        climb &= ~fall
        x[go], y[go] = x[go] + step * by, y[go] + step * by
        x[rise], y[rise] = up[rise], over[rise]
        x[fall], y[fall] = edge[x[fall]], edge[y[fall]]
        stay = inside & (x >= 0)
        x, y, who, climb = x[stay], y[stay], who[stay], climb[stay]
    return out


def _grid(begin: np.ndarray, size: np.ndarray, min_length: int, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place, period, needed stretch) of the harmonic grid of documents at ``begin``, in parts."""
    most = size // repeats
    start, n, q = np.repeat(begin, most), np.repeat(size, most), _within(most) + 1
    need = np.maximum(min_length - q, (repeats - 1) * q)
    counts = np.where(n >= min_length, (n - q + need - 1) // need, 0)
    done = np.cumsum(counts)
    at = 0
    while at < len(counts):
        upto = max(int(np.searchsorted(done, (done[at - 1] if at else 0) + GRID)), at + 1)
        part, c = slice(at, upto), counts[at:upto]
        yield np.repeat(start[part], c) + _within(c) * np.repeat(need[part], c), np.repeat(q[part], c), np.repeat(need[part], c)
        at = upto


def find_runs(docs: list[np.ndarray], min_length: int = MIN_LENGTH, repeats: int = MIN_REPEATS) -> list[np.ndarray]:
    """Runs of each document (word numbers from 1), a row (start, length, period) each, in order."""
    size = np.array([len(d) for d in docs], np.int64)
    begin = np.cumsum(size + 1) - size
    none = np.zeros(1, np.int64)
    text = np.concatenate([none, *(x for d in docs for x in (d, none))])
    g, found = None, [np.zeros((0, 3), np.int64)]
    for at, q, need in _grid(begin, size, min_length, repeats):
        hit = text[at] == text[at + q]
        at, q, need = at[hit], q[hit], need[hit]
        if not len(at):
            continue
        g = g or grammar(text)
        ahead = extension(g, at, at + q, True)
        back = extension(g, at - 1, at + q - 1, False)
        run = ahead + back >= need
        found.append(np.unique(np.stack([at - back, ahead + back + q, q], axis=1)[run], axis=0))
    # In order of start, length and period: the first of equal stretches has the least period.
    every = np.unique(np.concatenate(found), axis=0)
    new = np.ones(len(every), bool)
    new[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    every = every[new]
    every = every[np.lexsort((every[:, 2], every[:, 0]))]
    cuts = np.searchsorted(every[:, 0], begin)
    return [every[a:b] - [o, 0, 0] for a, b, o in zip(cuts, np.append(cuts[1:], len(every)), begin, strict=True)]


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(marks[:-1]) == 0).tolist()])


def _batches(texts: list[bytes | None]) -> Iterator[tuple[list[list[bytes]], list[np.ndarray]]]:
    """Words and their numbers, TOGETHER words or one text at a time."""
    words, size = [], 0
    for k, text in enumerate(texts):
        words.append(text.split() if text else [])
        size += len(words[-1])
        if size >= TOGETHER or k == len(texts) - 1:
            number = defaultdict(count(1).__next__)
            yield words, [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in words]
            words, size = [], 0


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, repeats: int = MIN_REPEATS, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, runs, collapsed and the digests of the last two for every row of ``docs``.

    Words are parted by spaces and \\x09-\\x0D. ``runs`` lists (start, length, period) of every stretch
    of ``min_length`` words and ``repeats`` periods or more that no neighbouring word prolongs, by
    start, then period. ``collapsed`` is the text without words that a run holds after its first
    period, one space between words (null with ``keep_text=False``; the digest stays).

    Null and empty texts have no words and no runs. Texts are whole; one of n words takes some 300 n
    bytes of a worker. Rows that share a doc_id or a null one are texts of their own. Needs doc_id and text, ignores
    other columns; an empty table gives no rows. No row leaves its task.
    """
    small_batches(docs.sparkSession, 500)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, at = batch.column(0), 0
        for words, numbers in _batches(batch.column(1).to_pylist()):
            found = find_runs(numbers, min_length, repeats)
            left = [collapse(w, r) for w, r in zip(words, found, strict=True)]
            flat = np.concatenate(found)
            offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
            listed = ["".join("%d,%d,%d\n" % (a, b, c) for a, b, c in r.tolist()).encode() for r in found]
            yield pa.RecordBatch.from_arrays([
                ids.slice(at, len(words)), pa.array([len(w) for w in words], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                    [pa.array(np.ascontiguousarray(flat[:, j])) for j in range(3)], ["start", "length", "period"])),
                pa.array(left, pa.binary()) if keep_text else pa.nulls(len(words), pa.binary()),
                pa.array([hashlib.sha256(x).hexdigest() for x in listed]),
                pa.array([hashlib.sha256(x).hexdigest() for x in left])],
                ["doc_id", "n_words", "runs", "collapsed", "runs_sha256", "collapsed_sha256"])
            at += len(words)

    done = map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8("text").alias("text")), run, SCHEMA)
    return done.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_best(found: DataFrame) -> DataFrame:
    """``found`` of ``periodic_runs`` with n_runs and the run of the greatest length / period (ties:
    smallest start, then period) as start, length, period and exponent_milli; nulls without runs."""
    # Compared crosswise, so without rounding.
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a))
    rows = found.withColumns({"n_runs": F.size("runs").cast("bigint"), "__best": best})
    rows = rows.withColumns({name: F.col(f"__best.{name}") for name in ("start", "length", "period")})
    return rows.withColumn("exponent_milli", F.expr("1000 * length div period")).drop("__best")


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, where one document in ten (h % 10 = 0 for h = crc32 of its doc_id) goes
    on in a loop: with g = h div 10, n words, a = g % n and p = 1 + (n - a) div (3 + g % 8), word
    i >= a is original word a + (i - a) % p. A null doc_id or text stays as it is."""
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))
    # explode keeps the optimizer from copying the words into the lambda.
    rows = rows.select("doc_id", "text", "h", F.explode(F.array(words)).alias("w")).withColumns({"g": F.expr("h div 10"), "n": F.size("w")})
    rows = rows.withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    loop = F.expr("array_join(transform(sequence(0, n - 1), i -> w[if(i < a, i, int(a + (i - a) % p))]), ' ')")
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), loop).otherwise(F.col("text")).alias("text"))
