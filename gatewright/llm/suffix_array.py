"""Exact removal of repeated substrings, by column-wise multi-document construction.

Which byte strings of ``width`` bytes start at more than one place of a
collection? Sorting all suffixes of a corpus in one place is out of the
question, so the work is first dealt out by content:

* Every window of ``width`` bytes names an anchor: its smallest hashed gram of
  ``gram`` bytes. Equal windows name equal anchors at equal places, so they
  meet at the anchor, and windows whose anchor occurs once are not repeated.
* The texts around the occurrences of one anchor, lined up at the anchor, are
  the documents of a small collection. Its transform is built column by
  column, from the last symbol to the first: each round inserts one symbol of
  every document, keeps the documents sorted by what follows (the order in
  which the inserted symbols are a column of the collection's Burrows-Wheeler
  transform), and updates the common prefixes of neighbours. A window is
  repeated if and only if the common prefix with a neighbour reaches ``width``.

The classical construction keeps one transform of all suffixes and reads and
writes it whole in each round: total length times longest document, on one
machine. Here suffixes of different columns never need comparing, so a round
touches one column only; the sequential external files are the sorted shuffle
files, of which each task reads its buckets once.

Windows may also be passages: as many words as asked for, from the start of a
word to the end of one, up to ``width`` bytes (longer ones hold a window of
``width`` bytes). They are measured one by one, so that neighbouring shorter
repeats never add up to a passage.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatewright.llm.common import WORD, ship
from gatewright.llm.sieve import sieve, sieved
from gatewright.session import SMALL_BATCHES, release, stored, work_scope, work_settings

ship(__name__)

WIDTH = 400
GRAM = 128
# Occurrences of one anchor that one task lines up, and documents in one set of rounds.
# Anchors with more occurrences are settled by hashes of their windows.
LARGE_ANCHOR = 16_384
ROUND_DOCUMENTS = 8_192

# Words of a passage, and the grams by which its windows meet: fifty words have 99 bytes at least.
PASSAGE_WORDS, PASSAGE_GRAM = 50, 64
# Rows of a batch that are Python objects at once, and texts that are measured, or whose repeats are told, at once.
PIECE, TOLD = 256, 1_024
# Bytes of short texts whose anchors are found at once: few enough for a processor's cache to hold their hashes.
STRETCH = 1 << 16

PLACE = "h:bigint,lo:int,hi:int,off:int"
SPANS = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("past", T.IntegerType())]))


def _mix(x: np.ndarray, room: np.ndarray) -> None:
    """In place; ``room`` is as long as ``x`` or longer."""
    room = room[:len(x)]
    np.right_shift(x, np.uint64(31), out=room)
    x ^= room
    x *= np.uint64(0x9E3779B97F4A7C15)
    np.right_shift(x, np.uint64(29), out=room)
    x ^= room


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes (a power of two) from each place on:
    a polynomial of the mixed bytes, by halves, mixed again at the end. Grams
    that share a hash by chance cost a comparison, never a result."""
    h = data.astype(np.uint64)
    h += np.uint64(1)
    room = np.empty_like(h)
    _mix(h, room)
    size, power = 1, 0x9E3779B97F4A7C15
    while size < gram:
        count = max(0, len(h) - size)
        np.multiply(h[:count], np.uint64(power), out=room[:count])
        room[:count] += h[size:]
        h, room = room[:count], h
        size, power = 2 * size, power * power % (1 << 64)
    _mix(h, room)
    return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size, least = 1, values
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[:len(values) - width + 1], least[width - size:])
    return least


def _placed(h: np.ndarray, least: np.ndarray, low: np.uint64, starts: np.ndarray, text: np.ndarray,
            begins: np.ndarray, count: int):
    """``(places, tied)`` of every text, from the first and the last place of each
    window's smallest gram. Windows in a row with one and the same place share it;
    those in which the gram stands twice have none."""
    first, last = (least[0] & low).astype(np.int64), (low - (least[1] & low)).astype(np.int64)
    alone = np.flatnonzero(first == last)
    cuts = np.flatnonzero((first[alone][1:] != first[alone][:-1]) | (np.diff(alone) > 1)) + 1
    head = alone[np.concatenate(([0], cuts))] if len(alone) else alone
    tail = alone[np.append(cuts, len(alone)) - 1] if len(alone) else alone
    place, of = first[head], text[head]
    rows = np.stack((h[place].view(np.int64), starts[head] - begins[of], starts[tail] - begins[of], place - starts[head]), 1)
    tied = np.flatnonzero(first != last)
    bounds = np.arange(1, count)
    rows = np.split(rows, np.searchsorted(of, bounds))
    tied_starts = np.split(starts[tied] - begins[text[tied]], np.searchsorted(text[tied], bounds))
    return [(r, t.tolist()) for r, t in zip(rows, tied_starts)]


def _both_ends(h: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """Hashes with their place, and their place from behind, in the lower bits:
    minima are the first and the last place of the smallest."""
    low = np.uint64((1 << len(h).bit_length()) - 1)
    at = np.arange(len(h), dtype=np.uint64)
    return np.stack(((h & ~low) | at, (h & ~low) | (low - at))), low


def byte_anchors(texts: list[bytes], width: int, gram: int):
    """One ``(places, tied)`` for every text: the anchors ``(h, lo, hi, off)``, each
    for the windows that start at lo..hi and hold it at ``lo + off``; and the
    starts of the windows whose smallest gram occurs twice in them, which have
    none. Texts lie one behind the other, so that many short ones cost no more
    than a long one."""
    sizes = np.array([len(t) for t in texts])
    begins = np.cumsum(sizes) - sizes
    windows = np.maximum(sizes - width + 1, 0)
    text = np.repeat(np.arange(len(texts)), windows)
    if not len(text):
        return [(np.zeros((0, 4), np.int64), []) for _ in texts]
    starts = np.arange(len(text)) + np.repeat(begins - (np.cumsum(windows) - windows), windows)
    h = gram_hashes(np.frombuffer(b"".join(texts), np.uint8), gram)
    both, low = _both_ends(h)
    least = np.stack([sliding_min(x, width - gram + 1) for x in both])[:, starts]
    return _placed(h, least, low, starts, text, begins, len(texts))


def anchors_of(data: bytes, width: int, gram: int):
    return byte_anchors([data], width, gram)[0]


BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def passages(data: bytes, words: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all runs of so many words, of up to ``most`` bytes."""
    ink = np.pad(~BLANK[np.frombuffer(data, np.uint8)], 1)
    starts, ends = np.flatnonzero(ink[1:] & ~ink[:-1]), np.flatnonzero(ink[:-1] & ~ink[1:])
    starts, ends = starts[:max(0, len(starts) - words + 1)], ends[words - 1:]
    fit = ends - starts <= most
    return starts[fit], ends[fit]


def passage_anchors(texts: list[bytes], words: int, most: int, gram: int):
    """As ``byte_anchors``, for passages: lo and hi are starts of words. A passage has at
    least two bytes less one for each word, which ``gram`` must not exceed."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
    ink = np.pad(~BLANK[data], 1)
    starts, ends = np.flatnonzero(ink[1:] & ~ink[:-1]), np.flatnonzero(ink[:-1] & ~ink[1:])
    text = np.searchsorted(begins, starts, "right") - 1
    count = max(0, len(starts) - words + 1)
    fit = np.flatnonzero((text[:count] == text[words - 1:]) & (ends[words - 1:] - starts[:count] <= most))
    none = np.zeros((0, 4), np.int64)
    if not len(fit):
        return [(none, []) for _ in texts]
    starts, ends, text = starts[fit], ends[fit + words - 1], text[fit]
    h = gram_hashes(data, gram)
    both, low = _both_ends(h)
    return _placed(h, _range_min(both, starts, ends - gram), low, starts, text, begins, len(texts))


def window_rows(data: bytes, starts, ends) -> list[tuple[bytes, int, list[int]]]:
    """The windows' 128-bit hashes and sizes, each with its starts in this text."""
    found: dict[tuple[bytes, int], list[int]] = {}
    for s, e in zip(starts, ends):
        found.setdefault((xxhash.xxh3_128_digest(data[s:e]), e - s), []).append(s)
    return [(x, size, at) for (x, size), at in found.items()]


class Windows:
    """What is compared: every string of ``width`` bytes, or with ``words`` every passage of so many words."""

    def __init__(self, width: int, gram: int, words: int = 0):
        self.width, self.gram, self.words = width, gram, words

    def anchors(self, texts: list[bytes]):
        """``(places, tied)`` of every text."""
        out, at = [], 0
        while at < len(texts):
            past, size = at, 0
            while past < len(texts) and (past == at or size < STRETCH):
                size += len(texts[past])
                past += 1
            if self.words:
                out += passage_anchors(texts[at:past], self.words, self.width, self.gram)
            else:
                out += byte_anchors(texts[at:past], self.width, self.gram)
            at = past
        return out

    def ends(self, data: bytes, starts: list[int]) -> list[int]:
        if not self.words:
            return [s + self.width for s in starts]
        every, ends = passages(data, self.words, self.width)
        return ends[np.searchsorted(every, starts)].tolist()

    def needed(self, begin: np.ndarray, texts: list[bytes], columns: int) -> np.ndarray | None:
        """How long the common prefix has to be for each column and text, for passages."""
        if not self.words:
            return None
        need = np.full((columns, len(texts)), np.iinfo(np.int16).max, np.int16)
        for at in range(0, len(texts), TOLD):
            self._need(need[:, at:at + TOLD], begin[at:at + TOLD], texts[at:at + TOLD])
        return need

    def _need(self, need: np.ndarray, begin: np.ndarray, texts: list[bytes]) -> None:
        # all texts one behind the other, a blank between them
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        at = np.cumsum([0, *[len(t) + 1 for t in texts]])
        ink = np.pad(~BLANK[data], 1)
        starts, ends = np.flatnonzero(ink[1:] & ~ink[:-1]), np.flatnonzero(ink[:-1] & ~ink[1:])
        text = np.searchsorted(at, starts, "right") - 1
        count = max(0, len(starts) - self.words + 1)
        size = ends[self.words - 1:] - starts[:count]
        fit = np.flatnonzero((text[:count] == text[self.words - 1:]) & (size <= self.width))
        of = text[fit]
        need[begin[of] + starts[fit] - at[of], of] = size[fit]


def pieces(batches):
    """The same rows, ``PIECE`` at most at once: as Python objects they take many times a batch's bytes."""
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            yield batch.slice(at, PIECE)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def text_key(text):
    """16 bytes that stand for the text: the first of its SHA-256."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def _words(data: bytes) -> int:
    ink = ~BLANK[np.frombuffer(data, np.uint8)]
    return int(np.count_nonzero(ink[1:] & ~ink[:-1]) + ink[:1].sum())


def _place_lists(places: list[np.ndarray]) -> pa.Array:
    """A list of structs for each array of rows ``(h, lo, hi, off)``."""
    flat = np.concatenate([np.zeros((0, 4), np.int64), *places])
    ends = np.cumsum([0, *map(len, places)])
    fields = [pa.array(flat[:, 0]), *(pa.array(flat[:, i].astype(np.int32)) for i in (1, 2, 3))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
        fields, ["h", "lo", "hi", "off"]))


def anchored(docs: DataFrame, windows: Windows) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(batches):
        for batch in pieces(batches):
            keys, sizes, shas, words, places, ties = [], [], [], [], [], []
            texts = [_bytes(text) for text in batch.column("text").to_pylist()]
            for data, (place, tied) in zip(texts, windows.anchors(texts)):
                sha = hashlib.sha256(data)
                keys.append(sha.digest()[:16])
                sizes.append(len(data))
                shas.append(sha.hexdigest())
                words.append(_words(data))
                places.append(np.array(place, np.int64).reshape(-1, 4))
                ties.append([{"x": x, "size": n, "starts": s}
                             for x, n, s in window_rows(data, tied, windows.ends(data, tied))])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                pa.array(shas, pa.string()), pa.array(words, pa.int64()),
                _place_lists(places),
                pa.array(ties, pa.list_(pa.struct([
                    ("x", pa.binary()), ("size", pa.int32()), ("starts", pa.list_(pa.int32()))])))],
                ["doc_id", "tkey", "n_bytes", "sha", "n_words", "places", "ties"])

    return docs.mapInArrow(each, f"doc_id {kind}, tkey binary, n_bytes long, sha string, n_words long, "
                                 f"places array<struct<{PLACE}>>, ties array<struct<x:binary,size:int,starts:array<int>>>")


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minima of ``values[lo..hi]``, by tables of powers of two."""
    length = hi - lo + 1
    level = np.frexp(length.astype(np.float64))[1] - 1
    out = np.empty((*values.shape[:-1], len(lo)), values.dtype)
    least = values
    for k in range(int(level.max()) + 1):
        if k:
            least = np.minimum(least[..., :-(1 << (k - 1))], least[..., 1 << (k - 1):])
        at = np.flatnonzero(level == k)
        out[..., at] = np.minimum(least[..., lo[at]], least[..., hi[at] - (1 << k) + 1])
    return out


def column_rounds(group: np.ndarray, off: np.ndarray, texts: list[bytes], width: int, windows: Windows | None = None):
    """``(row, first, last)`` runs of repeated window starts, counted from each
    text's begin. ``group`` numbers the collections, not decreasing; texts are
    lined up at ``off``. For passages, ``(row, first, past)``: the stretches that they cover."""
    m = len(texts)
    size = np.array([len(t) for t in texts])
    left = int(off.max())
    begin = left - off
    end = begin + size
    columns = np.zeros((m, int(end.max())), np.uint8)
    for i, (b, text) in enumerate(zip(begin.tolist(), texts)):
        columns[i, b:b + len(text)] = np.frombuffer(text, np.uint8)
    columns = np.ascontiguousarray(columns.T)
    group = group.astype(np.int32)  # sorted, and stays so in every order
    order = np.arange(m)
    prefix = np.zeros(m, np.int16)  # common with the neighbour before
    repeated = np.zeros((left + 1, m), bool)
    need = None if windows is None else windows.needed(begin, texts, left + 1)
    for j in range(len(columns) - 1, -1, -1):
        symbol = columns[j][order].astype(np.uint16)
        symbol[(begin[order] > j) | (end[order] <= j)] = 256  # no symbol here
        perm = np.argsort(symbol, kind="stable")
        perm = perm[np.argsort(group[perm], kind="stable")]
        symbol, of = symbol[perm], group[perm]
        same = np.flatnonzero((symbol[1:] == symbol[:-1]) & (of[1:] == of[:-1]) & (symbol[1:] < 256)) + 1
        longer = np.zeros(m, np.int16)
        if len(same):
            longer[same] = _range_min(prefix, perm[same - 1] + 1, perm[same]) + 1
        prefix, order = longer, order[perm]
        if j <= left:
            least = width if need is None else need[j][order]
            hit = prefix >= least
            hit[:-1] |= prefix[1:] >= (width if need is None else least[:-1])
            repeated[j, order] = hit
    told = [_runs(repeated[:, at:at + TOLD], None if need is None else need[:, at:at + TOLD]) for at in range(0, m, TOLD)]
    rows, first, past = (np.concatenate(x) for x in zip(*((r + k * TOLD, f, p) for k, (r, f, p) in enumerate(told))))
    return rows, first - begin[rows], past - begin[rows]


def _runs(repeated: np.ndarray, need: np.ndarray | None):
    """Of some texts of ``column_rounds``, with columns for places."""
    if need is not None:
        rows, at = np.nonzero(repeated.T)
        past = at + need[at, rows]
        # a stretch ends where the next passage starts behind all before it
        reach = np.maximum.accumulate(past + rows * np.int64(1 << 32))
        begins = np.flatnonzero(np.concatenate(([len(rows) > 0], (at + rows * np.int64(1 << 32))[1:] > reach[:-1])))
        lasts = np.append(begins[1:], len(rows)) - 1 if len(begins) else begins
        return rows[begins], at[begins], (reach - rows * np.int64(1 << 32))[lasts]
    edges = np.diff(np.pad(repeated.T.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, first = np.nonzero(edges == 1)
    return rows, first, np.nonzero(edges == -1)[1] - 1


def contexts(texts: DataFrame, windows: Windows) -> DataFrame:
    """The text around each place that is not large: all its windows."""

    def each(batches):
        for batch in pieces(batches):
            for tkey, text, places in zip(*(batch.column(c).to_pylist() for c in ("tkey", "text", "places"))):
                data = _bytes(text)
                small = [p for p in places if p["h"] is not None and not p["large"]]
                ends = windows.ends(data, [p["hi"] for p in small])
                rows = [(p["h"], p["off"], data[p["lo"]:e], tkey, p["lo"]) for p, e in zip(small, ends)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (
                            pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32()))],
                        ["h", "off", "context", "tkey", "lo"])

    return texts.mapInArrow(each, "h long, off int, context binary, tkey binary, lo int")


def lined_up(rows: DataFrame, windows: Windows, documents: int = ROUND_DOCUMENTS) -> DataFrame:
    """``(tkey, first, past)`` of repeated windows; ``rows`` come sorted by anchor."""

    def rounds(table):
        h = table.column("h").to_numpy()
        group = np.concatenate(([0], np.cumsum(h[1:] != h[:-1])))
        row, first, past = column_rounds(
            group, table.column("off").to_numpy(), table.column("context").to_pylist(), windows.width, windows)
        past = past if windows.words else past + windows.width
        lo = table.column("lo").to_numpy()[row]
        return pa.RecordBatch.from_arrays(
            [table.column("tkey").take(pa.array(row)).combine_chunks(), pa.array((lo + first).astype(np.int32)),
             pa.array((lo + past).astype(np.int32))], ["tkey", "first", "past"])

    def each(batches):
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < documents:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            h = table.column("h").to_numpy()
            full = int(np.searchsorted(h, h[-1]))  # the last anchor may go on
            if full:
                yield rounds(table.slice(0, full))
            rest = table.slice(full)
            held, count = rest.to_batches(), rest.num_rows
        if count:
            yield rounds(pa.Table.from_batches(held).combine_chunks())

    return rows.mapInArrow(each, "tkey binary, first int, past int")


def _large_windows(texts: DataFrame, windows: Windows) -> DataFrame:
    """``(x, tkey, size, starts)``: hashes of the windows at large anchors."""

    def each(batches):
        for batch in pieces(batches):
            for tkey, text, places in zip(*(batch.column(c).to_pylist() for c in ("tkey", "text", "places"))):
                data = _bytes(text)
                starts = [s for p in places if p["large"] for s in range(p["lo"], p["hi"] + 1)]
                if windows.words and starts:
                    starts = np.intersect1d(starts, passages(data, windows.words, windows.width)[0]).tolist()
                if rows := window_rows(data, starts, windows.ends(data, starts)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x for x, _, _ in rows], pa.binary()), pa.array([tkey] * len(rows), pa.binary()),
                         pa.array([n for _, n, _ in rows], pa.int32()),
                         pa.array([s for _, _, s in rows], pa.list_(pa.int32()))], ["x", "tkey", "size", "starts"])

    return texts.mapInArrow(each, "x binary, tkey binary, size int, starts array<int>")


def _repeated_windows(rows: DataFrame) -> DataFrame:
    """``(tkey, first, past)`` of the windows whose hash has two starts or more."""
    often = rows.groupBy("x").agg(F.sum(F.size("starts")).alias("n")).where("n > 1").select("x")
    return rows.join(often, "x").select("tkey", "size", F.explode("starts").alias("first")).select(
        "tkey", "first", (F.col("first") + F.col("size")).alias("past"))


class Repeats:
    """What repeats in ``docs``, a row per distinct text.

    ``rows``: ``doc_id, tkey, n_bytes, sha, n_words`` of every row; ``copies``: ``tkey, n``;
    ``texts``: the distinct texts that may hold repeats; ``spans``: ``tkey, spans``,
    the repeated stretches, merged. A text that occurs twice repeats as a whole.
    With ``words``, passages of so many words take the place of strings of ``width`` bytes.
    """

    def __init__(self, docs: DataFrame, width: int = WIDTH, gram: int = GRAM, large: int = LARGE_ANCHOR,
                 words: int = 0):
        with work_settings(docs.sparkSession, SMALL_BATCHES):
            self._find(docs, Windows(width, gram, words), large)

    def _find(self, docs: DataFrame, windows: Windows, large: int) -> None:
        docs = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
        found = stored(anchored(docs, windows), "anchors")
        self.rows = found.select("doc_id", "tkey", "n_bytes", "sha", "n_words")
        once = stored(found.groupBy("tkey").agg(
            F.count("*").alias("n"), F.min("doc_id").alias("rep"), F.first("places").alias("places"),
            F.first("ties").alias("ties")), "texts")
        self.copies = once.select("tkey", "n")
        each = once.select("tkey", "rep", F.inline("places"))
        often = stored(each.groupBy("h").agg(F.count("*").alias("m")).where("m > 1"), "often")
        # only places whose anchor may be shared move, and only texts with such a place
        shared = sieved(each, sieve(often, F.col("h")), F.col("h")).join(often, "h").select("tkey", "rep", F.struct(
            "h", "lo", "hi", "off", (F.col("m") > large).alias("large")).alias("place"))
        ties = once.where(F.size("ties") > 0).select("tkey", "rep", F.inline("ties"))
        no_place = F.lit(None).cast(f"struct<{PLACE},large:boolean>")
        shared = shared.unionByName(ties.select("tkey", "rep", no_place.alias("place")))
        wanted = shared.groupBy("tkey", "rep").agg(F.collect_list("place").alias("places"))
        wanted = stored(wanted.withColumnRenamed("tkey", "k"), "wanted")
        at = (F.col("tkey") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("rep"))
        texts = docs.withColumn("tkey", text_key(F.col("text")))
        texts = sieved(texts, sieve(wanted, F.xxhash64("k")), F.xxhash64("tkey")).join(wanted, at)
        self.texts = stored(texts.select("tkey", "text", "places"), "shared-texts")
        spans = lined_up(contexts(self.texts, windows).repartition("h").sortWithinPartitions("h"), windows)
        spans = spans.unionByName(_repeated_windows(ties.select("x", "tkey", "size", "starts")))
        if not often.where(F.col("m") > large).isEmpty():
            spans = spans.unionByName(_repeated_windows(stored(_large_windows(self.texts, windows), "windows")))
        merged = spans.groupBy("tkey").agg(F.sort_array(F.collect_set(F.struct("first", "past"))).alias("spans"))
        self.spans = stored(merged.select("tkey", merge_spans("spans").alias("spans")), "spans")


def _merged(column: pa.Array) -> pa.Array:
    """All lists at once, in numbers: as Python objects they would take many times their bytes."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    first, past = (column.flatten().field(k).to_numpy() for k in ("first", "past"))
    row = np.repeat(np.arange(len(sizes)), sizes)
    lists = row * np.int64(1 << 32)
    reach = np.maximum.accumulate(past + lists)
    begins = np.flatnonzero(np.concatenate(([len(row) > 0], (first + lists)[1:] > reach[:-1])))
    lasts = np.append(begins[1:], len(row)) - 1 if len(begins) else begins
    ends = np.cumsum([0, *np.bincount(row[begins], minlength=len(sizes)).tolist()])
    fields = [pa.array(first[begins].astype(np.int32)), pa.array((reach - lists)[lasts].astype(np.int32))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["first", "past"]))


def merge_spans(spans: str):
    """Sorted ``(first, past)`` with those joined that overlap or touch."""

    @F.arrow_udf(SPANS)
    def merge(column: pa.Array) -> pa.Array:
        return _merged(column)

    return merge(F.col(spans))


def repeat_report(docs: DataFrame, *, width: int = WIDTH, gram: int = GRAM, large: int = LARGE_ANCHOR) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row.

    Each byte that is covered by a string of ``width`` bytes which also starts
    elsewhere, in any row, goes. A null text is empty; texts shorter than
    ``width`` never change; repeated rows are copies of each other and go
    whole; ids play no part in what repeats. Other columns are not looked at.
    """
    return _report(Repeats(docs, width, gram, large), width).drop("tkey", "n", "n_words")


def _report(found: Repeats, width: int) -> DataFrame:

    def digest(batches):
        for batch in pieces(batches):
            keys, removed, count, shas = [], [], [], []
            for tkey, text, spans in zip(*(batch.column(c).to_pylist() for c in ("tkey", "text", "spans"))):
                data = _bytes(text)
                at, kept = 0, hashlib.sha256()
                for s in spans:
                    kept.update(data[at:s["first"]])
                    at = s["past"]
                kept.update(data[at:])
                keys.append(tkey)
                removed.append(sum(s["past"] - s["first"] for s in spans))
                count.append(len(spans))
                shas.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
                 pa.array(shas, pa.string())], ["tkey", "removed", "spans", "kept"])

    cut = found.texts.select("tkey", "text").join(found.spans, "tkey").mapInArrow(
        digest, "tkey binary, removed long, spans long, kept string").dropDuplicates(["tkey"])
    known = found.copies.join(cut, "tkey", "left").where("n > 1 or removed is not null")
    rows = found.rows.join(known, "tkey", "left")
    whole = (F.col("n") > 1) & (F.col("n_bytes") >= width)
    return rows.select(
        "tkey", "n", "n_words", "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("spans", F.lit(0).cast("long"))).alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"))


def passage_spans(docs: DataFrame, words: int, width: int, gram: int, large: int) -> DataFrame:
    """``(tkey, spans)`` of the texts with repeated passages; all else that was made for it is freed."""
    with work_scope() as made:
        spans = Repeats(docs, width, gram, large, words).spans
    release(docs.sparkSession, made, but=spans)
    return spans


def joined(spans: DataFrame, more: DataFrame) -> DataFrame:
    both = spans.unionByName(more).groupBy("tkey").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    return both.select("tkey", merge_spans("spans").alias("spans"))


def word_count(text: str):
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD))


def passage_report(docs: DataFrame, *, words: int = PASSAGE_WORDS, width: int = WIDTH, gram: int = GRAM,
                   word_gram: int = PASSAGE_GRAM, large: int = LARGE_ANCHOR) -> DataFrame:
    """``repeat_report`` with ``n_with_passages``: the bytes that ``remove`` cuts
    with ``words``, those in repeated passages of so many words as well. Rows as there."""
    more = passage_spans(docs, words, width, word_gram, large)
    found = Repeats(docs, width, gram, large)
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["past"] - s["first"]).cast("long"))
    part = stored(joined(found.spans, more).select("tkey", size.alias("part")), "parts")
    rows = _report(found, width).join(part, "tkey", "left")
    whole = (F.col("n") > 1) & (F.col("n_words") >= words)
    return rows.withColumn("n_with_passages", F.when(whole, F.col("n_bytes")).otherwise(
        F.greatest("n_removed", F.coalesce("part", F.lit(0).cast("long"))))).drop("part", "tkey", "n", "n_words")


def op5_suffix_array(spark, sf_dir: str) -> DataFrame:
    return passage_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def cut_text(data: bytes, spans) -> str:
    """The text without the spans. A character that is only partly covered stays."""
    at, kept = 0, []
    for s in spans:
        first, past = s["first"], s["past"]
        while first < past and data[first] & 0xC0 == 0x80:
            first += 1
        while past > first and past < len(data) and data[past] & 0xC0 == 0x80:
            past -= 1
        kept.append(data[at:first])
        at = past
    kept.append(data[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


def remove(docs: DataFrame, *, width: int = WIDTH, gram: int = GRAM, large: int = LARGE_ANCHOR,
           words: int = 0, word_gram: int = PASSAGE_GRAM) -> DataFrame:
    """``docs`` with repeated strings of ``width`` bytes cut out of ``text``, all rows and columns kept.

    With ``words``, repeated passages of so many words go as well, whatever their
    bytes. ``n_chars``, where there is one, follows the text. Rows that lose all
    their text stay, with an empty one; null texts stay null; repeated rows are
    copies and lose all. An empty table stays one.
    """
    with work_scope() as made:
        more = passage_spans(docs, words, width, word_gram, large) if words else None
        found = Repeats(docs, width, gram, large)
        spans = found.spans
        if words:
            spans = joined(spans, more)
        known = found.copies.join(spans, "tkey", "left").where("n > 1 or spans is not null")
        known = stored(known.select(F.col("tkey").alias("__k"), (F.col("n") > 1).alias("__whole"),
                                    F.col("spans").alias("__spans")), "cuts")
    release(docs.sparkSession, made, but=known)

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for batch in pieces([pa.RecordBatch.from_arrays([texts, spans], ["text", "spans"])]):
            both = zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())
            out.append(pa.array([None if s is None else cut_text(_bytes(t), s) for t, s in both], pa.string()))
        return pa.concat_arrays(out) if out else texts

    # a text that loses nothing stays where it is
    key, held = F.xxhash64(text_key(docs["text"])), sieve(known, F.xxhash64("__k"))
    rows = sieved(docs, held, key).join(known, text_key(docs["text"]) == F.col("__k"), "left")
    whole = F.col("__whole") & (F.octet_length("text") >= width)
    if words:
        whole = F.col("__whole") & ((F.octet_length("text") >= width) | (word_count("text") >= words))
    # only the texts that lose a part go through Python
    partly = F.col("__spans").isNotNull() & ~F.col("__whole")
    rows = rows.withColumn("__cut", cut(F.when(partly, F.col("text")), F.when(partly, F.col("__spans"))))
    out = rows.withColumn("text", F.when(whole, F.lit("")).otherwise(F.coalesce("__cut", "text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("__k").isNull(), F.col("n_chars")).otherwise(
            F.char_length("text").cast(kind)))
    return out.select(*docs.columns).unionByName(sieved(docs, held, key, out=True))
