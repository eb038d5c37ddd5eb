"""Token counts by merging whole batches of pre-tokens at once.

New pre-tokens of a batch are held as one ragged array of symbols. In each round every sequence
applies its lowest-ranked pair, the leftmost of equals, until none is left; what survives is
counted. Counts of pre-tokens met before come from a bounded table in the worker.
"""
from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from msgledger.llm.common import small_batches, worker_cache
from msgledger.llm.vocab import Pieces, load, pretokens

LIMIT = 4096
KNOWN = 1_000_000  # pre-tokens a worker remembers; beyond, it starts anew
LONG = 1000  # symbols; a longer run merges through a heap, since rounds would be as many
NONE = np.iinfo(np.int32).max


class Merger:
    """Pair ranks of a vocabulary and the merging of many symbol sequences."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        order = {s: r for r, s in enumerate(sorted(set(pieces.scores.values()), reverse=True))}
        pairs, self.inside = {}, set()
        for text, whole in pieces.ids.items():
            self.inside.update(zip(text, text[1:], strict=False))
            for at in range(1, len(text)):
                a, b = pieces.ids.get(text[:at]), pieces.ids.get(text[at:])
                if a is not None and b is not None:
                    pairs[a, b] = (order[pieces.scores[whole]], whole)
        self.pairs = pairs
        keys = np.array([(a << 32) | b for a, b in pairs], np.int64)
        sort = np.argsort(keys)
        self.keys = np.append(keys[sort], np.iinfo(np.int64).max)
        values = np.array([*pairs.values(), (NONE, 0)][: len(pairs)] or [(NONE, 0)], np.int64)
        self.ranks = np.append(values[sort, 0] if len(pairs) else [], NONE).astype(np.int32)
        self.wholes = np.append(values[sort, 1] if len(pairs) else [], 0).astype(np.int64)
        self.known: dict[str, int] = {}
        self.cut = pretokens(pieces)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (a << 32) | b
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NONE), self.wholes[at]

    def runs(self, token: str) -> tuple[int, list[list[int]]]:
        """Symbols that can never merge, counted, and the runs of those that may."""
        alone, runs, last = 0, [], None
        for char in token:
            symbol = self.pieces.ids.get(char)
            if symbol is None:
                alone += len(char.encode("utf-8", "surrogatepass"))
            elif runs and last is not None and (last, char) in self.inside:
                runs[-1].append(symbol)
            else:
                runs.append([symbol])
            last = char if symbol is not None else None
        return alone + sum(len(r) == 1 for r in runs), [r for r in runs if len(r) > 1]

    def count_new(self, tokens: list[str]) -> None:
        sequences, owners = [], []
        counts = np.zeros(len(tokens), np.int64)
        for i, token in enumerate(tokens):
            counts[i], runs = self.runs(token)
            for run in runs:
                if len(run) > LONG:
                    counts[i] += self.merge_long(run)
                else:
                    sequences.append(run)
                    owners.append(i)
        if sequences:
            np.add.at(counts, np.array(owners), self.merge(sequences))
        self.known.update(zip(tokens, counts.tolist(), strict=True))

    def merge(self, sequences: list[list[int]]) -> np.ndarray:
        """Symbols left of each sequence."""
        out = np.ones(len(sequences), np.int64)
        name = np.arange(len(sequences))
        sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
        symbols = np.concatenate([np.array(s, np.int64) for s in sequences]) if len(sequences) < 64 else np.fromiter(
            (x for s in sequences for x in s), np.int64, int(sizes.sum()))
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        ranks = np.full(len(symbols), NONE, np.int32)
        wholes = np.zeros(len(symbols), np.int64)
        ranks[:-1], wholes[:-1] = self.look_up(symbols[:-1], symbols[1:])
        ranks[starts + sizes - 1] = NONE
        while len(name):
            best = np.minimum.reduceat(ranks, starts)
            ended = best == NONE
            if ended.any():
                out[name[ended]] = sizes[ended]
                stay = np.repeat(~ended, sizes)
                symbols, ranks, wholes = symbols[stay], ranks[stay], wholes[stay]
                name, sizes, best = name[~ended], sizes[~ended], best[~ended]
                if not len(name):
                    break
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            of = np.repeat(np.arange(len(name)), sizes)
            hits = np.flatnonzero(ranks == best[of])
            at = hits[np.concatenate(([True], of[hits][1:] != of[hits][:-1]))]
            symbols[at] = wholes[at]
            # The pair to the right of the merged symbol is the one its second half had.
            last = at + 1 == starts + sizes - 1
            after = np.minimum(at + 2, len(symbols) - 1)
            rank, whole = self.look_up(symbols[at], symbols[after])
            ranks[at], wholes[at] = np.where(last, NONE, rank), whole
            inner = at > starts
            left = at[inner] - 1
            ranks[left], wholes[left] = self.look_up(symbols[left], symbols[at[inner]])
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, ranks, wholes = symbols[keep], ranks[keep], wholes[keep]
            sizes = sizes - 1
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        return out

    def merge_long(self, run: list[int]) -> int:
        """The same merges for one long run, in time n log n."""
        symbols, after, before = list(run), list(range(1, len(run) + 1)), list(range(-1, len(run) - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(symbols) and (found := self.pairs.get((symbols[i], symbols[j]))):
                heapq.heappush(heap, (found[0], i, found[1], symbols[i], symbols[j]))

        for i in range(len(symbols) - 1):
            offer(i)
        left = len(symbols)
        while heap:
            _, i, whole, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= len(symbols) or symbols[j] != b:
                continue
            symbols[i], symbols[j] = whole, -1
            after[i] = after[j]
            if after[j] < len(symbols):
                before[after[j]] = i
            left -= 1
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return left

    def counts(self, texts: list[str | None]) -> list[int]:
        if len(self.known) > KNOWN:
            self.known.clear()
        out = []
        for at in range(0, len(texts), 200):
            cut = [self.cut(t) for t in texts[at:at + 200]]
            new = set().union(*cut).difference(self.known)
            if new:
                self.count_new(list(new))
            out += [sum(map(self.known.__getitem__, tokens)) for tokens in cut]
        return out


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text.

    Counts equal those of the model's own library without begin and end tokens; strings that look
    like special tokens are ordinary text. Null and empty texts have no tokens. Long texts are
    whole; only their distinct pre-tokens are merged. Repeated rows give repeated results, null
    ids stay null, other columns are ignored, and an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    pieces = load(model)

    @F.arrow_udf(T.LongType())
    def count(text: pa.Array) -> pa.Array:
        merger = worker_cache(f"merger:{pieces.name}", lambda: Merger(pieces))
        return pa.array(merger.counts(text.to_pylist()), pa.int64())

    got = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
                      count("text").alias("n_tokens"))
    return got.withColumn("over_limit", F.col("n_tokens") > limit)
