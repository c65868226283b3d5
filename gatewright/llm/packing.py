"""Packing documents into sequences by patterns of lengths.

Everything about lengths is settled on the histogram, which has as many rows as
a sequence has tokens, whatever the corpus: patterns of up to three documents
that fill a sequence are fitted to it by non-negative least squares, repeat
counts are rounded, and what is left is packed best fit first. The result is a
list of patterns with repeat counts. Documents are then numbered within their
length, in parallel, and the number says which place of which sequence is theirs.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gatewright.llm.common import ship
from gatewright.llm.tokens import worker_encoder
from gatewright.session import stored

ship(__name__)

LENGTH = 2048
END = 0
# Lengths are fitted in so many classes at most.
CLASSES = 512
# Rows that are numbered together.
CHUNK = 50_000


def cut_points(n: int, length: int) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: only the first may be shorter."""
    first = n if n <= length else (n % length or length)
    return [(0, first), *((s, length) for s in range(first, n, length))]


def pieces(docs: DataFrame, length: int = LENGTH, *, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, ids`` without the ids: the
    pieces of every row. A null text is the end mark alone."""
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def each(batches):
        encoder = worker_encoder(path)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            row, number, start, size, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = memoryview(encoder.encode(text) + end)
                for k, (s, n) in enumerate(cut_points(len(ids) // 4, length)):
                    row.append(i)
                    number.append(k)
                    start.append(s)
                    size.append(n)
                    crc.append(zlib.crc32(ids[4 * s:4 * (s + n)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(each, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def patterns(classes: int) -> np.ndarray:
    """Every way to fill ``classes`` with two or three positive classes, smallest
    last; a missing third is 0."""
    found = [(a, classes - a, 0) for a in range((classes + 1) // 2, classes)]
    for c in range(1, classes // 3 + 1):
        rest = classes - c
        b = np.arange(c, rest // 2 + 1)
        found.extend(zip((rest - b).tolist(), b.tolist(), [c] * len(b)))
    return np.array(found, np.int64).reshape(-1, 3)


def fit(columns: np.ndarray, target: np.ndarray, rounds: int = 400, together: int = 16) -> np.ndarray:
    """Non-negative x that brings the sum of patterns close to ``target``: least
    squares by active sets. Each round lets in the patterns that lower the error
    fastest, no two of which share a class, solves for those that are in, and
    steps back where a count would turn negative."""
    n = len(columns)
    x = np.zeros(n)
    active = np.zeros(n, bool)
    scale = max(float(target.max()), 1.0)
    goal = target / scale
    goal[0] = 0

    def matrix(which):
        a = np.zeros((len(goal), len(which)))
        for slot in range(columns.shape[1]):
            np.add.at(a, (columns[which, slot], np.arange(len(which))), 1.0)
        a[0] = 0
        return a

    residual = goal.copy()
    for _ in range(rounds):
        gain = residual[columns].sum(1)
        gain[active] = -np.inf
        best = np.argsort(-gain)[:64 * together]
        best = best[gain[best] > 1e-9]
        if not len(best):
            break
        used, new = set(), 0
        for p in best.tolist():
            mine = set(columns[p].tolist()) - {0}
            if not mine & used:
                used |= mine
                active[p] = True
                new += 1
                if new == together:
                    break
        while True:
            which = np.flatnonzero(active)
            a = matrix(which)
            z = np.linalg.solve(a.T @ a + 1e-9 * np.eye(len(which)), a.T @ goal)
            if (z > 1e-12).all():
                break
            low = z <= 1e-12
            now = x[which]
            step = np.min(np.where(low, now / np.maximum(now - z, 1e-15), 1.0))
            now = now + step * (z - now)
            out = low & (now <= 1e-12)
            if not out.any():
                out = low
            now[out] = 0
            x[which] = now
            active[which[out]] = False
        x[:] = 0
        x[which] = z
        before = float(residual @ residual)
        residual = goal - a @ z
        if before - float(residual @ residual) < 1e-10:
            break
    return x * scale


def _takes(stock: dict[int, int], members: list[int], down: bool):
    """Runs ``(length, count)`` of a class's lengths, longest or shortest first."""
    return [(n, stock[n]) for n in sorted(members, reverse=down) if stock.get(n)]


def pack_histogram(histogram: dict[int, int], length: int = LENGTH, classes: int = CLASSES) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, count)``: so many sequences hold documents of these lengths.
    Every document of the histogram is in exactly one."""
    stock = {int(n): int(c) for n, c in histogram.items() if c}
    done: list[tuple[tuple[int, ...], int]] = []
    if stock.get(length):
        done.append(((length,), stock.pop(length)))
    grain = -(-length // classes)
    classes = length // grain
    members: dict[int, list[int]] = {}
    counts = np.zeros(classes + 1)
    for n, c in stock.items():
        k = -(-n // grain)
        if k > classes:  # only where the grain doesn't divide the length
            continue
        members.setdefault(k, []).append(n)
        counts[k] += c
    opened: list[tuple[tuple[int, ...], int]] = []
    columns = patterns(classes) if classes >= 2 else np.zeros((0, 3), np.int64)
    if len(columns):
        there = counts > 0
        there[0] = True
        columns = columns[there[columns].all(1)]
    if len(columns):
        repeats = np.floor(fit(columns, counts.copy()) + 1e-9).astype(np.int64)
        for p in np.argsort(-repeats).tolist():
            if repeats[p] <= 0:
                break
            opened.extend(_fill([k for k in columns[p].tolist() if k], int(repeats[p]), stock, members))
    done.extend(_best_fit(stock, opened, length))
    return done


def _fill(slots: list[int], times: int, stock: dict[int, int], members: dict[int, list[int]]):
    """Up to ``times`` sequences of one document from each slot's class, as runs
    of equal lengths; long ones of the first slot meet short ones of the others."""
    out = []
    while times > 0:
        chosen, need = [], {}
        for i, k in enumerate(slots):
            order = sorted(members[k], reverse=i == 0)
            n = next((n for n in order if stock[n] > need.get(n, 0)), None)
            if n is None:
                return out
            chosen.append(n)
            need[n] = need.get(n, 0) + 1
        count = min(times, *(stock[n] // c for n, c in need.items()))
        for n, c in need.items():
            stock[n] -= c * count
        out.append((tuple(sorted(chosen, reverse=True)), count))
        times -= count
    return out


def _best_fit(stock: dict[int, int], opened, length: int):
    """What is left goes, longest first, into the sequence with the least room that
    is enough, or into new ones; equal sequences are handled together."""
    room: dict[int, dict[tuple[int, ...], int]] = {}
    spaces: list[int] = []

    def put(pattern, count):
        space = length - sum(pattern)
        if space not in room:
            room[space] = {}
            bisect.insort(spaces, space)
        room[space][pattern] = room[space].get(pattern, 0) + count

    for pattern, count in opened:
        put(pattern, count)
    for n in sorted((n for n, c in stock.items() if c), reverse=True):
        left = stock[n]
        while left:
            at = bisect.bisect_left(spaces, n)
            if at == len(spaces):
                each = min(length // n, left)
                count = left // each
                put((n,) * each, count)
                left -= count * each
                continue
            space = spaces[at]
            pattern, count = next(iter(room[space].items()))
            each = min(space // n, left)
            moved = min(count, left // each)
            if moved == count:
                del room[space][pattern]
                if not room[space]:
                    del room[space]
                    spaces.pop(at)
            else:
                room[space][pattern] = count - moved
            put((*pattern, *(n,) * each), moved)
            left -= moved * each
        stock[n] = 0
    return [(p, c) for groups in room.values() for p, c in groups.items()]


def placement(packed) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: from which number on, in which first sequence, at which offset."""
    places: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for pattern, count in packed:
        offset = 0
        for n in pattern:
            first = taken.get(n, 0)
            places.setdefault(n, []).append((first, sequence, offset))
            taken[n] = first + count
            offset += n
        sequence += count
    return {n: tuple(np.array(c, np.int64) for c in zip(*rows)) for n, rows in places.items()}


def numbered(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``rows`` with ``rank``: 0, 1, ... within each length, without a task that
    sees all rows of a length: rows are dealt into chunks by a hash, numbered
    within chunk and length, and start after the counts of earlier chunks."""
    chunks = max(1, -(-rows.count() // chunk))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(chunks)))
    counts = rows.groupBy("chunk", "length").count()
    earlier = W.partitionBy("length").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("chunk", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0).cast("long")).alias("base"))
    inside = W.partitionBy("chunk", "length").orderBy("doc_id", "piece", "start", "ids_crc32")
    rows = rows.withColumn("inside", F.row_number().over(inside) - 1)
    return rows.join(starts, ["chunk", "length"]).withColumn("rank", F.col("base") + F.col("inside"))


def pack(docs: DataFrame, length: int = LENGTH, *, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece.

    Repeated rows are packed as often as they come, rows without an id too; an
    empty table gives no rows; other columns are not looked at. Only the
    histogram of lengths, ``length`` rows at most, comes to the driver.
    """
    cut = stored(pieces(docs, length, path=path), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    places = placement(pack_histogram(histogram, length))
    rows = numbered(cut)

    def each(batches):
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            for n in np.unique(size).tolist():
                at = np.flatnonzero(size == n)
                first, base, where = places[n]
                k = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at] = base[k] + rank[at] - first[k]
                offset[at] = where[k]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = cut.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        each, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op6_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
