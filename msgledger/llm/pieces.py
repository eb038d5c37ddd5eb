"""N-best segmentation into pieces, and decoding.

A text is a chain of pre-tokens that no piece lies across, so its lattice is a chain of small
lattices. In each, a forward Viterbi pass gives the best score up to every place; these scores
are the exact heuristic of an A* search that runs backward from the end and so meets the
segmentations in order of score. The n best of a whole text differ from its best one only in
the few pre-tokens whose second-best segmentation costs least; only those are searched.
"""
from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from msgledger.llm.common import small_batches, worker_cache
from msgledger.llm.vocab import SPACE, Pieces, load, pretokens

N_BEST = 4
KNOWN = 100_000  # pre-tokens a worker remembers, some 230 bytes each; beyond, it starts anew
KNOWN_FOR_DIGESTS = 600_000  # where no ids are sent back, there is room for more, some 300 bytes each
RESULT = T.StructType([
    T.StructField("pieces", T.ArrayType(T.IntegerType())), T.StructField("scores", T.ArrayType(T.LongType())),
    T.StructField("n_best", T.ArrayType(T.ArrayType(T.IntegerType()))), T.StructField("decoded", T.StringType()),
    T.StructField("alike", T.BooleanType())])
DIGESTS = T.StructType([
    T.StructField("n_pieces", T.LongType()), T.StructField("scores", T.ArrayType(T.LongType())), T.StructField("ids_sha256", T.StringType()),
    T.StructField("others_sha256", T.ArrayType(T.StringType())), T.StructField("round_trip", T.BooleanType())])
ALIKE = 48  # pre-tokens up to this length are segmented many at once
SQUARE = 20_000  # characters of them at a time
CHUNK = 400  # texts digested together
BATCH = 100  # texts segmented together, whose ids all go back at once
NEVER = -(1 << 62)
NOT_HERE = (None, False)


class Segmented(NamedTuple):
    """Ids of the best segmentation, scores of the n best, and the ids of the others."""

    ids: np.ndarray
    scores: list[int]
    others: list[np.ndarray] | None


class Lattice:
    """Segmentations of pre-tokens. Scores are the model's own, as whole numbers.

    A character that is no piece becomes its bytes, at a score below every ordinary piece.
    Pre-tokens met before are kept in flat arrays: best score, ids, loss of the second best.
    """

    def __init__(self, pieces: Pieces, room: int | None = None, digests: bool = True):
        self.room, self.with_forms = room, digests
        self.ids = pieces.ids
        self.byte_ids = pieces.byte_ids
        self.score_of = {p: round(pieces.scores[i]) for p, i in pieces.ids.items()}
        self.unknown = min((s for s in self.score_of.values() if s > -1e8), default=0) - 10
        self.starts = {p[:k] for p in pieces.ids for k in range(1, len(p))}
        # Of each piece and each beginning of one: its score, and whether longer pieces begin so.
        self.step = {p: (self.score_of.get(p), p in self.starts) for p in {*self.starts, *self.score_of}}
        self.inside = {pair for p in pieces.ids for pair in zip(p, p[1:], strict=False)}
        self.pretokens = pretokens(pieces)
        self._make_tree()
        self.bytes_of = {i: p.encode("utf-8") for p, i in pieces.ids.items()} | {
            i: bytes([b]) for b, i in pieces.byte_ids.items()}
        self.name_of = {i: str(i).encode() for i in self.bytes_of}
        self.forget()

    def cut(self, text: str | None) -> list[str]:
        """Pre-tokens; long ones are cut further, between characters that no piece has side by side."""
        tokens = self.pretokens(text)
        if max(map(len, tokens), default=0) <= ALIKE:
            return tokens
        out = []
        for token in tokens:
            start = 0
            for at in range(1, len(token) if len(token) > ALIKE else 0):
                if (token[at - 1], token[at]) not in self.inside:
                    out.append(token[start:at])
                    start = at
            out.append(token[start:])
        return out

    def _make_tree(self) -> None:
        """The beginnings of pieces as a tree: an edge (node, character) leads to the longer one."""
        names = sorted(self.step, key=len)
        number = {"": 0, **{p: n for n, p in enumerate(names, 1)}}
        edges = np.array([(number[p[:-1]] << 21) | ord(p[-1]) for p in names], np.int64)
        order = np.argsort(edges)
        self.edges, self.targets = edges[order], (order + 1).astype(np.int64)
        self.node_score = np.array([NEVER, *(NEVER if self.step[p][0] is None else self.step[p][0] for p in names)], np.int64)
        self.node_id = np.array([-1, *(self.ids.get(p, -1) for p in names)], np.int64)

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.tokens: list[str] = []
        self.forms: list[bytes] = []
        self.swaps: dict[int, list[tuple[int, list[int]]]] = {}
        self.wrong: set[int] = set()
        self.best, self.loss, self.flat, self.ends = array("q"), array("q"), array("i"), array("q", [0])

    def arcs(self, token: str, start: int) -> list[tuple[int, int]]:
        """(end, score) of the pieces that start here; an unknown character is one arc."""
        out = []
        for end in range(start + 1, len(token) + 1):
            part = token[start:end]
            score = self.score_of.get(part)
            if score is not None:
                out.append((end, score))
            if part not in self.starts:
                break
        if not out or out[0][0] != start + 1:
            out.insert(0, (start + 1, self.unknown * len(token[start].encode("utf-8", "surrogatepass"))))
        return out

    def ids_of(self, part: str) -> list[int]:
        i = self.ids.get(part)
        return [i] if i is not None else [self.byte_ids[b] for b in part.encode("utf-8", "surrogatepass")]

    def first(self, token: str) -> tuple[int, list[int], int]:
        """Best score, its ids, and the loss of the second-best segmentation (NEVER: there is one only).

        One forward pass that keeps the best two scores of each place.
        """
        size = len(token)
        one, two, by = [NEVER] * size, [NEVER] * size, [0] * (size + 1)
        one.append(NEVER)
        two.append(NEVER)
        one[0] = 0
        step = self.step.get
        for start in range(size):
            base, second = one[start], two[start]
            for end in range(start + 1, size + 1):
                score, more = step(token[start:end], NOT_HERE)
                if score is None:
                    if end > start + 1:
                        if more:
                            continue
                        break
                    score = self.unknown * len(token[start].encode("utf-8", "surrogatepass"))
                here = base + score
                if here > one[end]:
                    two[end] = one[end] if one[end] > second + score else second + score
                    one[end], by[end] = here, start
                elif here > two[end]:
                    two[end] = here
                if not more:
                    break
        parts, at = [], size
        while at:
            parts.append(token[by[at]:at])
            at = by[at]
        ids = [i for part in reversed(parts) for i in self.ids_of(part)]
        loss = one[size] - two[size]
        return one[size], ids, loss if two[size] > NEVER // 2 else -NEVER

    def n_best(self, token: str, n: int) -> list[tuple[int, list[int]]]:
        """(score, ids) of the n best segmentations, best first, by backward A*.

        No place is on more than n of the n best ends, so each is opened n times at most.
        """
        size = len(token)
        best = [0] + [NEVER] * size
        into: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
        for start in range(size):
            for end, score in self.arcs(token, start):
                into[end].append((start, score))
                best[end] = max(best[end], best[start] + score)
        order, opened = 0, [0] * (size + 1)
        heap = [(-best[size], order, size, 0, ())]
        out = []
        while heap and len(out) < n:
            negative, _, at, done, path = heapq.heappop(heap)
            if not at:
                ids, here = [], 0
                while path:
                    ids += self.ids_of(token[here:path[0]])
                    here, path = path
                out.append((-negative, ids))
                continue
            opened[at] += 1
            if opened[at] > n:
                continue
            for start, score in into[at]:
                order += 1
                heapq.heappush(heap, (-(best[start] + done + score), order, start, done + score, (at, path)))
        return out

    def learn(self, tokens: Iterable[str]) -> None:
        by_size: dict[int, list[str]] = {}
        for token in tokens:
            by_size.setdefault(len(token), []).append(token)
        for size, same in by_size.items():
            if size > ALIKE or len(same) < 8:
                for token in same:
                    self._add([token], *([x] for x in self.first(token)))
                continue
            for at in range(0, len(same), SQUARE // size):
                self._learn_alike(same[at:at + SQUARE // size], size)

    def _add(self, tokens: list[str], best, ids, loss) -> None:
        self.known.update(zip(tokens, range(len(self.tokens), len(self.tokens) + len(tokens)), strict=True))
        self.tokens.extend(tokens)
        self.best.extend(best)
        self.loss.extend(loss)
        flat, ends, forms, name, part = self.flat, self.ends, self.forms, self.name_of.__getitem__, self.bytes_of.__getitem__
        for token, found in zip(tokens, ids, strict=True):
            if b"".join(map(part, found)) != token.encode("utf-8", "surrogatepass"):
                self.wrong.add(len(ends) - 1)
            flat.extend(found)
            ends.append(len(flat))
            if self.with_forms:
                forms.append(b" ".join(map(name, found)))

    def spells(self, token: str, ids: Iterable[int]) -> bool:
        """Whether ids decode to a pre-token."""
        return b"".join(map(self.bytes_of.__getitem__, ids)) == token.encode("utf-8", "surrogatepass")

    def _learn_alike(self, tokens: list[str], size: int) -> None:
        """``first`` for many pre-tokens of one length at once: a row each, one pass over places."""
        chars = np.array(tokens, f"<U{size}").view(np.uint32).reshape(len(tokens), size).astype(np.int64)
        # scores[n - 1][row, start]: the piece of n characters there; NEVER if there is none.
        scores, ids = [], []
        row, start = (x.ravel() for x in np.indices(chars.shape))
        node = np.zeros(len(row), np.int64)
        for n in range(1, size + 1):
            key = (node << 21) | chars[row, start + n - 1]
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            hit = self.edges[at] == key
            row, start, node = row[hit], start[hit], self.targets[at[hit]]
            if not len(row):
                break
            score, piece = np.full(chars.shape, NEVER), np.full(chars.shape, -1)
            score[row, start], piece[row, start] = self.node_score[node], self.node_id[node]
            scores.append(score)
            ids.append(piece)
            more = start + n < size
            row, start, node = row[more], start[more], node[more]
        plain = (scores[0] > NEVER).all(axis=1) if scores else np.zeros(len(tokens), bool)
        for k in np.flatnonzero(~plain):  # a character that is no piece
            self._add([tokens[k]], *([x] for x in self.first(tokens[k])))
        keep = np.flatnonzero(plain)
        if not len(keep):
            return
        scores, ids = [s[keep] for s in scores], [i[keep] for i in ids]
        one, two = np.full((len(keep), size + 1), NEVER), np.full((len(keep), size + 1), NEVER)
        by = np.zeros((len(keep), size + 1), np.int64)
        one[:, 0] = 0
        for end in range(1, size + 1):
            best, second = one[:, end], two[:, end]
            for n in range(min(end, len(scores)), 0, -1):
                score = scores[n - 1][:, end - n]
                if n > 1 and not (score > NEVER).any():
                    continue
                here, next_ = one[:, end - n] + score, two[:, end - n] + score
                better = here > best
                second = np.where(better, np.maximum(best, next_), np.maximum(second, here))
                best = np.where(better, here, best)
                by[better, end] = n
            one[:, end], two[:, end] = best, second
        parts: list[list[int]] = [[] for _ in keep]
        at, rows = np.full(len(keep), size), np.arange(len(keep))
        stack = np.stack(ids)
        while len(rows):
            n = by[rows, at[rows]]
            at[rows] -= n
            for r, i in zip(rows.tolist(), stack[n - 1, rows, at[rows]].tolist(), strict=True):
                parts[r].append(i)
            rows = rows[at[rows] > 0]
        loss = np.where(two[:, size] > NEVER // 2, one[:, size] - two[:, size], -NEVER)
        self._add([tokens[k] for k in keep], one[:, size].tolist(), (p[::-1] for p in parts), loss.tolist())

    def _cut_all(self, texts: Sequence[str | None]) -> list[list[str]]:
        """Pre-tokens of texts, all of them known afterwards."""
        if len(self.known) > (self.room or KNOWN):
            self.forget()
        cut = [self.cut(t) for t in texts]
        self.learn(set().union(*cut).difference(self.known))
        return cut

    def digests(self, texts: Sequence[str | None], n: int) -> list[tuple[int, list[int], list[str], bool]]:
        """Number of pieces, scores and digests of the n best segmentations, and whether all decode to the text.

        A digest is of the ids in decimals, a space between. Decoding is proved part by part: the
        pre-tokens make up the text, and each one's ids decode to it, those of the changed ones too.
        """
        cut = self._cut_all(texts)
        best, loss, ends = (np.frombuffer(x, x.typecode) if len(x) else np.zeros(0, np.int64) for x in (self.best, self.loss, self.ends))
        out = []
        for text, tokens in zip(texts, cut, strict=True):
            at = np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))
            numbers = at.tolist()
            scores, changed = self._merge(at, int(best[at].sum()), loss[at], n) if numbers else ([], [])
            parts = list(map(self.forms.__getitem__, numbers))
            hashes = [hashlib.sha256(b" ".join(parts)).hexdigest()]
            right = "".join(tokens) == (SPACE + text.replace(" ", SPACE) if text else "") and SPACE not in (text or "")
            right &= not self.wrong or self.wrong.isdisjoint(numbers)
            for swap in changed:
                kept = {k: parts[k] for k in swap}
                for k, ids in swap.items():
                    parts[k] = b" ".join(map(self.name_of.__getitem__, ids))
                    right &= self.spells(tokens[k], ids)
                hashes.append(hashlib.sha256(b" ".join(parts)).hexdigest())
                for k, form in kept.items():
                    parts[k] = form
            out.append((int((ends[at + 1] - ends[at]).sum()), scores, hashes, right))
        return out

    def segment(self, texts: Sequence[str | None], n: int, others: bool = False) -> list[Segmented]:
        cut = self._cut_all(texts)
        best, loss, flat, ends = (np.frombuffer(x, x.typecode) if len(x) else np.zeros(0, np.int64) for x in (
            self.best, self.loss, self.flat, self.ends))
        out = []
        for tokens in cut:
            at = np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))
            ids = _ragged(flat, ends[at], ends[at + 1])
            scores, changed = self._merge(at, int(best[at].sum()), loss[at], n) if len(at) else ([], [])
            rest = None
            if others:
                places = np.concatenate(([0], np.cumsum(ends[at + 1] - ends[at])))
                rest = [_swapped(ids, places, swap) for swap in changed]
            out.append(Segmented(ids, scores, rest))
        return out

    def _merge(self, at: np.ndarray, total: int, loss: np.ndarray, n: int) -> tuple[list[int], list[dict]]:
        """Scores of the n best of a whole text, and what each of the others changes.

        Only the n - 1 pre-tokens with the cheapest change can differ.
        """
        few = np.argpartition(loss, n - 2)[:n - 1] if len(loss) >= n else np.arange(len(loss))
        plans: list[tuple[int, dict[int, list[int]]]] = [(0, {})]
        for k in sorted(few[loss[few] < -NEVER].tolist()):
            token = int(at[k])
            other = self._others(token, n)
            plans = sorted(
                [*plans, *((a + b, {**swap, k: ids}) for a, swap in plans for b, ids in other)], key=lambda p: p[0])[:n]
        return [total - a for a, _ in plans], [swap for _, swap in plans[1:]]

    def _others(self, token: int, n: int) -> list[tuple[int, list[int]]]:
        """(loss, ids) of the segmentations of a known pre-token after its best."""
        found = self.swaps.get(token)
        if found is None or len(found) < n - 1:
            kept = self.flat[self.ends[token]:self.ends[token + 1]].tolist()
            found = [(self.best[token] - s, ids) for s, ids in self.n_best(self.tokens[token], n) if ids != kept][:n - 1]
            self.swaps[token] = found
        return found[:n - 1]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a segmentation: pieces joined, byte pieces as UTF-8, the first space dropped."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")[1:]


def _ragged(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The stretches [start, end) of ``flat``, one after the other."""
    sizes = end - start
    if not len(sizes):
        return flat[:0]
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(start - before, sizes) + np.arange(int(sizes.sum()))]


def _swapped(ids: np.ndarray, places: np.ndarray, swap: dict[int, list[int]]) -> np.ndarray:
    """``ids`` with other ids for some pre-tokens; pre-token k begins at ``places[k]``."""
    parts, done = [], 0
    for k in sorted(swap):
        parts += [ids[done:places[k]], np.asarray(swap[k], ids.dtype)]
        done = places[k + 1]
    return np.concatenate([*parts, ids[done:]])


def _lists(values: Sequence[np.ndarray]) -> pa.ListArray:
    """One list of ids per row."""
    offsets = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def segmented(text: Column, model: str, n: int = N_BEST, others: bool = False) -> Column:
    """A struct: ``pieces`` (ids of the best), ``scores`` (of the n best, descending), ``n_best``
    (ids of the others, if asked for), ``decoded`` (the text again) and ``alike`` (whether each of
    the others decodes to the same; null if not asked for)."""
    pieces = load(model)

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        lattice = worker_cache(f"lattice:{pieces.name}", lambda: Lattice(pieces, digests=False))
        found = []
        for k in range(0, len(texts), BATCH):
            found += lattice.segment(texts.slice(k, BATCH).to_pylist(), n, others)
        back = [lattice.decode(f.ids.tolist()) for f in found]
        n_best, alike = pa.nulls(len(found), pa.list_(pa.list_(pa.int32()))), pa.nulls(len(found), pa.bool_())
        if others:
            counts = np.cumsum([0, *(len(f.others) for f in found)], dtype=np.int32)
            n_best = pa.ListArray.from_arrays(pa.array(counts), _lists([o for f in found for o in f.others]))
            alike = pa.array([all(lattice.decode(o.tolist()) == t for o in f.others) for f, t in zip(found, back, strict=True)], pa.bool_())
        return pa.StructArray.from_arrays(
            [_lists([f.ids for f in found]), pa.array([f.scores for f in found], pa.list_(pa.int64())),
             n_best, pa.array(back, pa.string()), alike], ["pieces", "scores", "n_best", "decoded", "alike"])

    return run(text)


def encode(docs: DataFrame, model: str, n: int = N_BEST, others: bool = False) -> DataFrame:
    """``docs`` with a struct ``encoded``, see ``segmented``.

    Null and empty texts have no pieces and decode to the empty text. A text that holds the space
    mark itself decodes with a space there. Texts are whole. Equal scores keep the order of the
    search, which depends on the text alone. All columns pass through; an empty table gives no rows.
    """
    small_batches(docs.sparkSession, BATCH)
    return docs.withColumn("encoded", segmented(F.col("text"), model, n, others))


def summary(docs: DataFrame, model: str, n: int = N_BEST) -> DataFrame:
    """doc_id, n_pieces, n_segmentations, the scores and digests of the n best, and whether all of
    them decode to the text."""
    small_batches(docs.sparkSession, 400)
    pieces = load(model)

    @F.arrow_udf(DIGESTS)
    def run(texts: pa.Array) -> pa.Array:
        lattice = worker_cache(f"lattice-digests:{pieces.name}", lambda: Lattice(pieces, KNOWN_FOR_DIGESTS))
        values, found = texts.to_pylist(), []
        for k in range(0, len(values), CHUNK):
            found += lattice.digests(values[k:k + CHUNK], n)
        size, scores, hashes, right = zip(*found, strict=True) if found else ((), (), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(size, pa.int64()), pa.array(scores, pa.list_(pa.int64())), pa.array([h[0] for h in hashes], pa.string()),
             pa.array([h[1:] for h in hashes], pa.list_(pa.string())), pa.array(right, pa.bool_())],
            ["n_pieces", "scores", "ids_sha256", "others_sha256", "round_trip"])

    done = docs.select("doc_id", run(F.col("text")).alias("d"))
    return done.select("doc_id", "d.n_pieces", F.size("d.scores").cast("bigint").alias("n_segmentations"), "d.scores", "d.ids_sha256",
                       "d.others_sha256", "d.round_trip")
