"""Best-fit packing of documents into sequences by bin completion on the histogram of piece lengths.

Pieces have at most `capacity` lengths, so how many pieces there are of each is a table of bounded size
whatever the input. The search fills sequences on that table, on the driver; executors then hand the places
out, each piece taking the one of its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter, deque
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, slices, texts_of
from .tokens import TOKENIZER, encoder

#: Fillings that a search tries; about a thousand reach the bound where it can be reached.
NODES = 2_000

#: Ways of up to `FEW` pieces come first, by their waste and a price for each piece: short pieces are worth keeping.
PRICE, FEW = 12, 4

Filling = tuple[int, ...]  # lengths in one sequence, longest first
Packing = list[tuple[Filling, int]]  # fillings and how many sequences have each


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: Martello and Toth's second bound, over every threshold."""
    n = np.zeros(capacity + 1, np.int64)
    n[[*counts]] = [*counts.values()]
    size = np.arange(capacity + 1) * n
    half, k = capacity // 2, np.arange(capacity // 2 + 1)
    numbers, sizes = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(size)])
    large, middle = numbers[-1] - numbers[capacity - k + 1], numbers[capacity - k + 1] - numbers[half + 1]
    room = middle * capacity - (sizes[capacity - k + 1] - sizes[half + 1])
    rest = sizes[half + 1] - sizes[np.maximum(k, 1)] - room
    return max(-(-int(size.sum()) // capacity), int((large + middle + np.maximum(0, -(-rest // capacity))).max()))


def best_fit(counts: dict[int, int], capacity: int) -> Packing:
    """Best-fit decreasing, all pieces of a length at once: each goes where least room is left after it."""
    open_: dict[int, list[tuple[Filling, int]]] = {capacity: []}
    rooms: list[int] = []

    def put(room: int, filling: Filling, number: int) -> None:
        if room not in open_ or not open_[room]:
            open_[room] = []
            bisect.insort(rooms, room)
        open_[room].append((filling, number))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            k = bisect.bisect_left(rooms, length)
            if k == len(rooms):
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    put(capacity - each * length, (length,) * each, full)
                if rest:
                    put(capacity - rest * length, (length,) * rest, 1)
                break
            room = rooms[k]
            filling, number = open_[room].pop()
            if not open_[room]:
                rooms.pop(k)
            used = min(left, number)
            if number > used:
                put(room, filling, number - used)
            put(room - length, (*filling, length), used)
            left -= used
    merged: Counter[Filling] = Counter()
    for group in open_.values():
        for filling, number in group:
            merged[filling] += number
    return list(merged.items())


def _spread(bits: int, by: int) -> int:
    """Every number that lies 0 to `by` above a number of the set."""
    done = 0
    while done < by:
        step = min(done + 1, by - done)
        bits |= bits << step
        done += step
    return bits


class Fillings:
    """The undominated fillings of a room from a stock of pieces, found one by one, least waste first.

    A filling is dominated if one piece outside it can take the place of some of its pieces (or of none) at no more
    room than is left: whatever a packing does with the first, it can do with the second. Sets of numbers are the
    bits of integers.
    """

    latest: deque[Fillings] = deque()

    def __init__(self, stock: np.ndarray, room: int) -> None:
        self.room, self.count = room, stock[: room + 1].tolist()
        self.lengths = [x for x in range(1, room + 1) if self.count[x]]
        self._reach: list[int] = []

    @property
    def reach(self) -> list[int]:
        """Sums of the pieces up to the k-th length. A search goes deep, so only the latest fillings keep theirs."""
        if not self._reach:
            whole = (1 << (self.room + 1)) - 1
            self._reach = [1]
            for x in self.lengths:
                bits, left, step = self._reach[-1], min(self.count[x], self.room // x), 1
                while left:  # 1, 2, 4 ... more of this length, `left` in all
                    k = min(step, left)
                    bits |= bits << (k * x)
                    left, step = left - k, 2 * step
                self._reach.append(bits & whole)
            Fillings.latest.append(self)
            if len(Fillings.latest) > 32:
                Fillings.latest.popleft()._reach = []
        return self._reach

    def with_waste(self, waste: int, fewest: int, most: int) -> Iterator[Filling]:
        """Those of `fewest` to `most` pieces that leave `waste` of the room, longer pieces first; what can't be undominated is given up at once."""
        if waste > self.room or not self.reach[-1] >> (self.room - waste) & 1:
            return
        if waste == self.room:
            if not self.lengths and not fewest:
                yield ()
            return
        outside = sum(1 << x for x in self.lengths)
        used = dict.fromkeys(self.lengths, 0)
        filling: list[int] = []

        def replaced(free: int, one: int, more: int) -> bool:
            """Whether a piece outside takes the place of a piece that is shorter, or of several."""
            return bool(free & _spread(more, waste) or (waste and free & _spread(one << 1, waste - 1)))

        # sums of one piece, of two or more; `k`: lengths that may still be taken
        def extend(left: int, k: int, free: int, one: int, more: int) -> Iterator[Filling]:
            if not left:
                if len(filling) >= fewest and (not waste or not free & ((2 << waste) - 1)):
                    yield tuple(filling)
                return
            for i in range(bisect.bisect_right(self.lengths, left, 0, k) - 1, -1, -1):
                x = self.lengths[i]
                if not self.reach[i + 1] >> left & 1 or x * (most - len(filling)) < left:
                    return  # shorter pieces reach even less
                if used[x] == self.count[x] or not self.reach[i + 1] >> (left - x) & 1:
                    continue
                used[x] += 1
                filling.append(x)
                now = free & ~(1 << x) if used[x] == self.count[x] else free
                new = more | ((one | more) << x)
                if not replaced(now, one | 1 << x, new):
                    yield from extend(left - x, i + 1, now, one | 1 << x, new)
                filling.pop()
                used[x] -= 1

        yield from extend(self.room - waste, len(self.lengths), outside, 0, 0)


def _ways(left: np.ndarray, capacity: int, spare: Callable[[], int]) -> Iterator[tuple[Filling, int]]:
    """Fillings around the largest piece left and how often to take each: as often as the pieces last, then fewer times.

    `spare` tells how much waste a packing may still have that needs fewer sequences than the best so far.
    """
    largest = int(np.flatnonzero(left)[-1])
    rest = left.copy()
    rest[largest] -= 1
    room = capacity - largest
    some = Fillings(rest, room)

    def order() -> Iterator[tuple[int, int, int]]:
        """(waste, least and most pieces) of ways in the order in which they are tried."""
        yield from ((cost - PRICE * n, n, n) for cost in range(min(room, spare()) + PRICE * FEW + 1) for n in range(FEW + 1))
        yield from ((waste, FEW + 1, room) for waste in range(min(room, spare()) + 1))

    for whole in (True, False):
        for waste, fewest, pieces in order():
            if not 0 <= waste <= min(room, spare()):
                continue
            for way in some.with_waste(waste, fewest, pieces):
                filling = (largest, *way)
                most = min(int(left[x]) // k for x, k in Counter(filling).items())
                if waste:
                    most = min(most, spare() // waste)
                yield from ((filling, times) for times in ([most] if whole else range(most - 1, 0, -1)) if times > 0)
                if waste > spare():
                    break


def bin_completion(counts: dict[int, int], capacity: int, nodes: int | None = NODES) -> Packing:
    """Branch and bound: fill the sequence of the largest piece left in each undominated way, stop where waste exceeds the bound.

    The best-fit packing is the first incumbent; at each branch, so is the way there with a best fit of what is left.
    A branch ends when its waste or the lower bound of what is left shows that it can't need fewer sequences. Branches
    are searched in waves, those that take the first way nearly everywhere before others, until the lower bound is
    reached or a wave has left no branch out: the incumbent then needs the fewest. `nodes` bounds the time where
    neither happens soon; None searches to the end. Lengths are 1 to `capacity`; no pieces give no sequences.
    """
    incumbent = best_fit(counts, capacity)
    best, least = sum(n for _, n in incumbent), lower_bound(counts, capacity)
    total = sum(length * n for length, n in counts.items())
    start = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        start[length] = n

    def ways(left: np.ndarray, wasted: int) -> Iterator[tuple[Filling, int]]:
        return _ways(left, capacity, lambda: (best - 1) * capacity - total - wasted)

    wave, all_tried = 0, False
    while best > least and not all_tried and nodes != 0:
        all_tried = True
        # a frame: pieces left, sequences so far, waste so far, ways not yet tried, how many of these may be passed over
        path: Packing = []
        stack = [(start, 0, 0, ways(start, 0), wave)]
        while stack and best > least and nodes != 0:
            left, used, waste, rest, pass_over = stack[-1]
            way = next(rest, None) if pass_over >= 0 else None
            if way is None:
                all_tried = all_tried and (pass_over >= 0 or next(rest, None) is None)
                stack.pop()
                if path:
                    path.pop()
                continue
            nodes = None if nodes is None else nodes - 1
            stack[-1] = (left, used, waste, rest, pass_over - 1)
            filling, times = way
            wasted = waste + times * (capacity - sum(filling))
            if -(-(total + wasted) // capacity) >= best:
                continue
            after = left.copy()
            for x, k in Counter(filling).items():
                after[x] -= k * times
            remaining = {int(x): int(after[x]) for x in np.flatnonzero(after)}
            if used + times + lower_bound(remaining, capacity) >= best:
                continue
            ending = best_fit(remaining, capacity)
            if (found := used + times + sum(n for _, n in ending)) < best:
                best, incumbent = found, [*path, way, *ending]
            if remaining:
                path.append(way)
                stack.append((after, used + times, wasted, ways(after, wasted), pass_over))
        wave += 1
    return incumbent


def places(packing: Packing) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first rank, first sequence and offset of each run of places that fillings have for it."""
    ranks: Counter[int] = Counter()
    out: dict[int, list[tuple[int, int, int]]] = {}
    first = 0
    for filling, times in packing:
        offset = 0
        for length in filling:
            out.setdefault(length, []).append((ranks[length], first, offset))
            ranks[length] += times
            offset += length
        first += times
    return {length: tuple(np.array(x, np.int64) for x in zip(*runs, strict=True)) for length, runs in out.items()}


def cut_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth): the pieces of each document; nth: rank among those of its length in this task.

    Only a document of more than `capacity` tokens is cut; its first piece takes what is left over. A null or
    empty text is its end id alone; rows with a null or repeated id are packed like any other.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, part = np.array([end_id], "<u4"), TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, "text"):
            rows: list[tuple[int | None, int, int, int, int, int]] = []
            for i, e in zip(batch.column("doc_id").to_pylist(), encoder(tokenizer)([t.decode() for t in texts_of(batch, "text")]), strict=True):
                ids = np.concatenate([e.astype("<u4"), end])
                start, piece = 0, 0
                while start < len(ids):
                    size = capacity if piece else (len(ids) - 1) % capacity + 1
                    rows.append((i, piece, start, size, zlib.crc32(ids[start : start + size]), int(ranks[size])))
                    ranks[size] += 1
                    start, piece = start + size, piece + 1
            if rows:
                c = [*zip(*rows, strict=True)]
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip(c[:5], types, strict=True)), pa.array([part] * len(rows), pa.int32()), pa.array(c[5], pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long")


def pack(spark: SparkSession, docs: DataFrame, capacity: int = 1024, nodes: int | None = NODES, **options: object) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. No documents, no rows."""
    scratch = Scratch(spark, "packing")
    pieces = scratch.table(cut_pieces(docs, capacity=capacity, **options), "pieces")
    per_part = scratch.table(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "counts")
    # at most `capacity` rows
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(bin_completion(counts, capacity, nodes))

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("nth").to_numpy() + batch.column("before").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            sizes, at = np.unique(length[order], return_index=True)
            for size, i, j in zip(sizes.tolist(), at.tolist(), [*at.tolist()[1:], len(order)], strict=True):
                first, seq, off = table[size]
                k = np.searchsorted(first, rank[order[i:j]], side="right") - 1
                sequence[order[i:j]], offset[order[i:j]] = seq[k] + rank[order[i:j]] - first[k], off[k]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranked = per_part.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    # the counts grow with the number of tasks, so they are no table to broadcast
    return pieces.join(ranked.hint("merge"), ["part", "length"]).mapInArrow(assign, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
