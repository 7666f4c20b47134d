"""Packing of documents' tokens into sequences of bounded length by bin completion.

Documents longer than a sequence are cut into pieces of its length; the first piece holds what
is left over. Only the numbers of pieces of each length matter for the packing, and there are
at most as many lengths as a sequence has tokens: this histogram is all that the driver gets.

The search takes the largest remaining piece and enumerates the fillings of the room beside it:
sets of remaining pieces to which no other can be added, without those that another filling
dominates (its pieces can be divided over the places of the other's pieces). It follows the
filling with the least waste first, applies it as often as the pieces allow while many are left
and once when few are, and goes back to the others. A branch ends where the used sequences and
the lower bound for the rest (volume, or Martello and Toth's bound with pieces over half a
sequence) reach the best solution. The first such solution is that of best-fit decreasing; any
better one replaces it. The search ends when the lower bound of the whole is met, or after
NODES branches, since the problem has no fast exact answer.

The solution is a list of (times, fillings). Pieces are numbered within their length without
moving them: a task numbers its own pieces, and running sums over the tasks' counts give each
task's first number. The number tells the sequence and the place in it.

Documents: null texts are empty and have the end id alone; each input row is a document of its
own, repeated rows and null identifiers included; an empty table gives an empty result. Columns
besides identifier and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize
from ledgerloom.llm.tokenfile import END_ID, id_batches

CAPACITY = 1024
#: Branches that the search looks at before it keeps the best solution so far.
NODES = 4000
#: With at most so many sequences left, fillings are applied once at a time.
TAIL = 200
#: Fillings enumerated one by one; where there are more, those of up to three pieces and a greedy rest.
SETS = 300
#: Fillings of a node that are followed.
WIDTH = 6

Filling = tuple[int, ...]
Steps = list[tuple[int, Filling]]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: Martello and Toth's L2 over all thresholds."""
    sizes = np.arange(capacity + 1)
    number, volume = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(counts * sizes))
    total, half = number[-1], capacity // 2
    k = np.arange(half + 1)
    alone = total - number[capacity - k + 1]
    large = number[capacity - k + 1] - number[half + 1]
    large_volume = volume[capacity - k + 1] - volume[half + 1]
    small_volume = volume[half + 1] - volume[k]
    rest = small_volume - (large * capacity - large_volume)
    return int((alone + large + np.maximum(0, -(-rest // capacity))).max())


def best_fit(counts: np.ndarray, capacity: int) -> Steps:
    """Best-fit decreasing over equal pieces at once: the fullest sequence with room takes as many as fit."""
    room: dict[int, list[tuple[int, Filling]]] = {}
    for size in range(capacity, 0, -1):
        left = int(counts[size])
        while left:
            fitting = [r for r in room if r >= size]
            if fitting:
                r = min(fitting)
                times, filling = room[r].pop()
                if not room[r]:
                    del room[r]
            else:
                r, times, filling = capacity, left, ()
            each = min(r // size, left)
            used = min(times, left // each)
            left -= used * each
            room.setdefault(r - each * size, []).append((used, filling + (size,) * each))
            if fitting and times > used:
                room.setdefault(r, []).append((times - used, filling))
    return [step for steps in room.values() for step in steps]


def fits_into(pieces: Filling, places: list[int]) -> bool:
    """Whether the pieces, largest first, can be divided over the places."""
    if not pieces:
        return True
    tried = set()
    for i, place in enumerate(places):
        if place >= pieces[0] and place not in tried:
            tried.add(place)
            places[i] -= pieces[0]
            if fits_into(pieces[1:], places):
                places[i] += pieces[0]
                return True
            places[i] += pieces[0]
    return False


def undominated(fillings: list[Filling], keep: int) -> list[Filling]:
    """The first `keep`, by sum and then fewest pieces, that no earlier one dominates."""
    out: list[Filling] = []
    for f in sorted(set(fillings), key=lambda f: (-sum(f), len(f), [-x for x in f])):
        if not any(len(f) <= 8 and fits_into(f, list(g)) for g in out):
            out.append(f)
            if len(out) == keep:
                break
    return out


def enumerate_fillings(sizes: list[int], counts: np.ndarray, room: int, most: int) -> list[Filling] | None:
    """All sets of pieces within the room that no further piece fits beside; None if there are more than `most`."""
    out: list[Filling] = []

    def go(i: int, room: int, held: tuple[int, ...], least_left: int) -> bool:
        """least_left: the smallest piece passed over, which must not fit in the end."""
        while i < len(sizes) and sizes[i] > room:
            i += 1
        if i == len(sizes):
            if room < least_left:
                out.append(held)
            return len(out) <= most
        size = sizes[i]
        have = int(counts[size])
        for n in range(min(have, room // size), -1, -1):
            passed = min(least_left, size) if n < have else least_left
            if not go(i + 1, room - n * size, held + (size,) * n, passed):
                return False
        return True

    return out if go(0, room, (), room + 1) else None


def greedy(counts: np.ndarray, floor: np.ndarray, held: Filling, room: int) -> Filling:
    """Adds the largest fitting piece until none fits. floor[x]: the largest available size up to x."""
    held = list(held)
    limit = room
    while room > 0 and (size := int(floor[min(limit, room)])):
        n = min(int(counts[size]) - held.count(size), room // size)
        held += [size] * n
        room -= n * size
        limit = size - 1
    return tuple(sorted(held, reverse=True))


def fillings(counts: np.ndarray, room: int, keep: int = WIDTH) -> list[Filling]:
    """Fillings of the room by remaining pieces, those with the least waste first."""
    if room <= 0:
        return [()]
    available = np.flatnonzero(counts[: room + 1])
    if not len(available):
        return [()]
    if counts[room]:
        return [(room,)]  # it dominates every other
    if len(available) <= 40:
        found = enumerate_fillings(available[::-1].tolist(), counts, room, SETS)
        if found is not None:
            return undominated(found, keep)
    floor = np.zeros(room + 1, np.int64)
    floor[available] = available
    floor = np.maximum.accumulate(floor)
    a = available[::-1]
    # Every second piece is the largest beside the first; one of the same size must exist twice.
    b = floor[np.minimum(room - a, a)]
    twice = (b == a) & (counts[a] < 2)
    b[twice] = floor[np.minimum(room - a, a - 1)][twice]
    order = np.argsort(room - a - b, kind="stable")[: 2 * keep]
    found = [greedy(counts, floor, tuple(x for x in (int(a[i]), int(b[i])) if x), room - int(a[i] + b[i])) for i in order]
    found += [greedy(counts, floor, (int(x),), room - int(x)) for x in a[:keep]]
    if all(sum(f) < room for f in found):
        some = a[:: max(1, len(a) // 200)]
        x, y = (z.ravel() for z in np.meshgrid(some, some, indexing="ij"))
        ok = (x > y) & (x + y < room)
        x, y = x[ok], y[ok]
        z = floor[np.minimum(room - x - y, y - 1)]
        for i in np.argsort(room - x - y - z, kind="stable")[: 2 * keep]:
            held = tuple(int(v) for v in (x[i], y[i], z[i]) if v)
            found.append(greedy(counts, floor, held, room - sum(held)))
    return undominated(found, keep)


def solve(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES) -> Steps:
    """(times, pieces of a sequence) that pack counts[s] pieces of each size s; see the module's text."""
    counts = counts.astype(np.int64).copy()
    steps: Steps = []
    if counts[capacity]:
        steps.append((int(counts[capacity]), (capacity,)))
        counts[capacity] = 0
    if not counts.any():
        return steps
    best = best_fit(counts, capacity)
    most = sum(n for n, _ in best)
    least = lower_bound(counts, capacity)
    trail: list[tuple[int, Filling, list[Filling]]] = []
    used = 0

    def branch() -> list[Filling]:
        largest = int(np.flatnonzero(counts)[-1])
        counts[largest] -= 1
        found = [(largest, *f) for f in fillings(counts, capacity - largest)]
        counts[largest] += 1
        return found

    def apply(filling: Filling) -> int:
        sizes, copies = np.unique(filling, return_counts=True)
        times = int((counts[sizes] // copies).min()) if most - used > TAIL else 1
        counts[sizes] -= times * copies
        return times

    choices = branch()
    while most > least and nodes > 0:
        if choices:
            filling, rest = choices[0], choices[1:]
            times = apply(filling)
            used += times
            trail.append((times, filling, rest))
            nodes -= 1
            if not counts.any():
                if used < most:
                    best, most = [(n, f) for n, f, _ in trail], used
            elif used + lower_bound(counts, capacity) < most:
                choices = branch()
                continue
        if not trail:
            break
        # Back to the last choice with another filling.
        times, filling, choices = trail.pop()
        used -= times
        sizes, copies = np.unique(filling, return_counts=True)
        counts[sizes] += times * copies
    return steps + best


class Plan:
    """Tells the sequence and the place in it of the n-th piece of a length."""

    def __init__(self, steps: Steps):
        self.n_sequences = 0
        slots: dict[int, list[tuple[int, int, int, int]]] = {}
        for times, filling in steps:
            offset = 0
            for size in sorted(set(filling), reverse=True):
                copies = filling.count(size)
                slots.setdefault(size, []).append((times * copies, copies, self.n_sequences, offset))
                offset += copies * size
            self.n_sequences += times
        self.slots = {size: np.array(rows, np.int64).T for size, rows in slots.items()}

    def place(self, size: int, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, copies, first, offset = self.slots[size]
        ends = np.cumsum(n)
        step = np.searchsorted(ends, number, side="right")
        within = number - (ends - n)[step]
        return first[step] + within // copies[step], offset[step] + within % copies[step] * size


PIECE = ["piece", "start", "length", "ids_crc32", "part", "number"]


def cut(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, number): every document's pieces, numbered within task and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for leads, ids, bounds in id_batches(batches, vocabulary):
            doc, rows = [], []
            for i in range(len(leads)):
                n = int(bounds[i + 1] - bounds[i]) + 1
                raw = ids[bounds[i] : bounds[i + 1]].astype("<u4").tobytes() + end
                start, stop, piece = 0, n - (n - 1) // capacity * capacity, 0
                while start < n:
                    doc.append(i)
                    rows.append((piece, start, stop - start, zlib.crc32(raw[4 * start : 4 * stop]), part, seen[stop - start]))
                    seen[stop - start] += 1
                    start, stop, piece = stop, stop + capacity, piece + 1
            table = np.array(rows, np.int64).reshape(-1, len(PIECE))
            lead = leads.take(pa.array(doc, pa.int64()))
            columns = [pa.array(table[:, k], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([lead, *columns], names=["id", *PIECE])

    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, number bigint")


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    pieces = materialize(cut(docs, vocabulary, id_col, text_col, end_id, capacity), "pieces")
    per_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in per_task.groupBy("length").agg(F.sum("n")).collect():  # one row per length
        histogram[length] = n
    plan = docs.sparkSession.sparkContext.broadcast(Plan(solve(histogram, capacity, nodes)))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    first = per_task.select("part", "length", F.coalesce(before, F.lit(0).cast("long")).alias("first"))
    numbered = pieces.join(first, ["part", "length"]).select("id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("first")).alias("number"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                sequence[at], offset[at] = plan.value.place(int(size), number[at])
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    id_type = pieces.schema["id"].dataType.simpleString()
    placed = numbered.mapInArrow(run, f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
    return placed.withColumnRenamed("id", id_col)
