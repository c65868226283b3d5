"""Alignment of two tokenizers over inverted pair bitmaps.

Both tokenizers cut the same bytes; where tokens of the two overlap they are
linked. Which pairs of ids are linked, how often in the corpus and in how many
documents, is kept inverted: per pair a compressed bitmap of the documents that
hold it, and bit planes of how often beyond the first. Documents are numbered
within bounded blocks; a pair's bitmap is the union of its containers in all
blocks, so that merging them is adding up their population counts. The counts
then go back along the postings to the documents.

Texts fall into segments where both tokenizers start afresh: at a single blank
between two characters that are not white space. Equal segments have equal
tokens and links, which a worker remembers.
"""

from __future__ import annotations

import hashlib
import sys
import types

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import ship, table
from gatewright.llm.tokens import Encoder
from gatewright.session import stored

ship(__name__)

PIECES = "piece_bpe_32k"
# Documents and characters of a block, characters of the segments that a worker
# remembers, and of those that it learns at a time.
BLOCK_DOCUMENTS, BLOCK_CHARACTERS, REMEMBERED, LEARNED = 4_096, 1 << 22, 1 << 22, 1 << 17
# A container of so many documents or more is a plain bitmap, of fewer a list of 16-bit numbers.
BITMAP_BYTES = BLOCK_DOCUMENTS // 8
DENSE = BITMAP_BYTES // 2

SEGMENT = r"(?<=\S) (?=\S)"


class Aligner:
    """Tokens of both tokenizers, and where they meet, segment by segment.

    Of every segment number the aligner knows the tokens (``n_a``, ``n_b``), the
    groups (``n_groups``, ``groups``), and the keys of its links: A id times the
    size of the B vocabulary plus B id. ``n_a`` is -1 where the bytes differ.
    """

    def __init__(self, bytes_path: str | None = None, pieces_path: str | None = None):
        import public_tokenizers
        import sentencepiece

        self.a = Encoder(bytes_path).fast
        self.b = sentencepiece.SentencePieceProcessor(
            model_file=pieces_path or public_tokenizers.path(f"{PIECES}.model"))
        self.a_bytes = [self.a.decode_single_token_bytes(i) for i in range(max(self.a._mergeable_ranks.values()) + 1)]
        self.b_bytes = []
        self.apart = True  # no piece goes on behind the start of a new word
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(
                bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode())
            self.apart &= "\u2581" not in piece.lstrip("\u2581")
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.cut = regex.compile(SEGMENT)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.size = 0
        self.groups: list[str] = []
        self.n_a, self.n_b, self.n_groups, self.n_links, self.keys = (np.zeros(0, np.int64) for _ in range(5))
        self.new: dict[str, list[np.ndarray]] = {name: [] for name in ("n_a", "n_b", "n_groups", "n_links", "keys")}

    def settle(self) -> None:
        """Put what was learned behind what was known."""
        for name, parts in self.new.items():
            if parts:
                setattr(self, name, np.concatenate((getattr(self, name), *parts)))
                parts.clear()

    def segments(self, text: str) -> list[str]:
        """Segments of blank + text, each from its blank on."""
        line = " " + text
        if not self.apart:
            return [line]
        parts = self.cut.split(line)
        return [parts[0], *[" " + p for p in parts[1:]]]

    def tokens(self, segments: list[str]) -> list[tuple | None]:
        """``(A ids, B ids, n_a, n_b)`` of stretches of the segments; None for a
        segment whose bytes differ. Segments that may stand side by side are cut
        as one text; where bytes differ, each half is."""
        text = "".join(segments)
        line = text.encode("utf-8", "surrogatepass")
        a = np.array(self.a.encode_ordinary(text), np.int64)
        b = np.array(self.b.encode(text[1:]), np.int64)
        if (b"".join(map(self.b_bytes.__getitem__, b.tolist())) == line
                and b"".join(map(self.a_bytes.__getitem__, a.tolist())) == line):
            ends = np.cumsum([len(s.encode("utf-8", "surrogatepass")) for s in segments])
            end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
            at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
            if (end_a[at_a] == ends).all() and (end_b[at_b] == ends).all():
                return [(a, b, np.diff(at_a + 1, prepend=0), np.diff(at_b + 1, prepend=0))]
        if len(segments) == 1:
            return [None]
        half = len(segments) // 2
        return self.tokens(segments[:half]) + self.tokens(segments[half:])

    def learn(self, segments: list[str]) -> None:
        if not segments:
            return
        side = [len(s) > 1 and not s[1].isspace() and not s[-1].isspace() for s in segments]
        alone = [s for s, x in zip(segments, side) if not x]
        segments = [s for s, x in zip(segments, side) if x]
        parts = self.tokens(segments) if segments else []
        segments += alone
        for s in alone:
            parts += self.tokens([s])
        good = np.concatenate([[False] if p is None else np.ones(len(p[2]), bool) for p in parts])
        kept = np.flatnonzero(good).tolist()
        n_a, n_b, n_groups, n_links = (np.full(len(segments), x) for x in (-1, 0, 0, 0))
        groups = [""] * len(segments)
        keys = np.zeros(0, np.int64)
        if kept:
            a, b, n_a[good], n_b[good] = (np.concatenate([p[i] for p in parts if p is not None]) for i in range(4))
            # the segments one behind the other; ends of segments are ends of both
            end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
            ends = np.union1d(end_a, end_b)
            i, j = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
            keys = a[i] * len(self.b_bytes) + b[j]  # one link for each stretch without an end in it
            both = (end_a[i] == ends) & (end_b[j] == ends)
            past_a, past_b = i[both] + 1, j[both] + 1
            last = np.cumsum(n_a[good])
            n_links[good] = np.diff(np.searchsorted(ends, end_a[last - 1]) + 1, prepend=0)
            n_groups[good] = np.diff(np.searchsorted(past_a, last) + 1, prepend=0)
            a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
            at_a = at_b = at = 0
            past_a, past_b = past_a.tolist(), past_b.tolist()
            lines = []
            for x, y in zip(past_a, past_b):
                lines.append(",".join(a_text[at_a:x]) + "|" + ",".join(b_text[at_b:y]))
                at_a, at_b = x, y
            for row, n in zip(kept, n_groups[good].tolist()):
                groups[row] = ";".join(lines[at:at + n])
                at += n
        for s in segments:
            self.number[s] = len(self.number)
            self.size += len(s)
        self.groups += groups
        for name, found in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups), ("n_links", n_links), ("keys", keys)):
            self.new[name].append(found)

    def align(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """The numbers of every text's segments; None for a text without tokens."""
        if self.size > REMEMBERED:
            self.forget()
        cut = [self.segments(t) if t else None for t in texts]
        fresh: set[str] = set()
        for c in cut:
            if c:
                fresh.update(c)
        fresh = sorted(fresh - self.number.keys())
        at = size = 0
        for past, s in enumerate(fresh, 1):
            size += len(s)
            if size >= LEARNED or past == len(fresh):
                self.learn(fresh[at:past])
                at, size = past, 0
        self.settle()
        out: list[np.ndarray | None] = []
        for c in cut:
            found = None if c is None else np.fromiter(map(self.number.__getitem__, c), np.int64, len(c))
            out.append(None if found is None or (self.n_a[found] < 0).any() else found)
        return out

    def links(self, found: list[np.ndarray | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(key, slot, times)`` in order: how often a pair is linked in each text."""
        slots = np.repeat(np.arange(len(found)), [0 if f is None else len(f) for f in found])
        numbers = np.concatenate([np.zeros(0, np.int64), *[f for f in found if f is not None]])
        segment, times = np.unique(slots * max(len(self.number), 1) + numbers, return_counts=True)
        slots, numbers = segment // max(len(self.number), 1), segment % max(len(self.number), 1)
        size = self.n_links[numbers]
        first = np.cumsum(self.n_links) - self.n_links
        at = np.repeat(first[numbers] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        code = self.keys[at] * BLOCK_DOCUMENTS + np.repeat(slots, size)
        times = np.repeat(times, size)
        order = np.argsort(code)
        code, times = code[order], times[order]
        if not len(code):
            return code, code, times
        starts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        code = code[starts]
        return code // BLOCK_DOCUMENTS, code % BLOCK_DOCUMENTS, np.add.reduceat(times, starts)


def worker_aligner(bytes_path: str | None = None, pieces_path: str | None = None) -> Aligner:
    """One aligner for each pair of vocabularies and Python worker."""
    kept = sys.modules.setdefault("_gatewright_worker", types.ModuleType("_gatewright_worker"))
    aligners = kept.__dict__.setdefault("aligners", {})
    if (bytes_path, pieces_path) not in aligners:
        aligners[bytes_path, pieces_path] = Aligner(bytes_path, pieces_path)
    return aligners[bytes_path, pieces_path]


# --- bitmaps ---------------------------------------------------------------------


def containers(slots: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Compressed bitmaps: one for each of the ranges, ``sizes`` long, of the ascending ``slots``."""
    dense = sizes >= DENSE
    offsets = np.concatenate(([0], np.cumsum(np.where(dense, BITMAP_BYTES, 2 * sizes))))
    data = np.zeros(int(offsets[-1]), np.uint8)
    listed = np.repeat(~dense, np.diff(offsets))
    data[listed] = slots[np.repeat(~dense, sizes)].astype("<u2").view(np.uint8)
    begins = np.cumsum(sizes) - sizes
    for i in np.flatnonzero(dense).tolist():
        bits = np.zeros(BITMAP_BYTES * 8, np.uint8)
        bits[slots[begins[i]:begins[i] + sizes[i]]] = 1
        data[offsets[i]:offsets[i + 1]] = np.packbits(bits, bitorder="little")
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def members(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(row, slot)`` of all documents in compressed bitmaps."""
    lengths = pa.compute.binary_length(bitmaps).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(bitmaps.to_pylist()), np.uint8)
    dense = lengths == BITMAP_BYTES  # a list has fewer bytes
    rows = [np.repeat(np.flatnonzero(~dense), lengths[~dense] // 2)]
    slots = [data[np.repeat(~dense, lengths)].view("<u2").astype(np.int64)]
    begins = np.cumsum(lengths) - lengths
    for i in np.flatnonzero(dense).tolist():
        found = np.flatnonzero(np.unpackbits(data[begins[i]:begins[i] + BITMAP_BYTES], bitorder="little"))
        rows.append(np.full(len(found), i))
        slots.append(found)
    return np.concatenate(rows), np.concatenate(slots)


def population(bitmaps: pa.Array) -> np.ndarray:
    """How many documents each compressed bitmap holds."""
    return np.bincount(members(bitmaps)[0], minlength=len(bitmaps))


def postings(key: np.ndarray, slot: np.ndarray, times: np.ndarray, n_b: int) -> dict[str, pa.Array]:
    """Pairs with their bitmaps, from ascending ``(key, slot)``. Plane ``bit``
    holds the documents whose links beyond the first have that bit in their number."""
    starts = np.flatnonzero(np.concatenate(([len(key) > 0], key[1:] != key[:-1])))
    sizes = np.diff(np.append(starts, len(key)))
    pair = np.repeat(np.arange(len(starts)), sizes)
    more = times - 1
    of, bits, planes = [], [], []
    bit = 0
    while (more >> bit).any():
        has = np.flatnonzero((more >> bit) & 1)
        pairs, counts = np.unique(pair[has], return_counts=True)
        of.append(pairs)
        bits.append(np.full(len(pairs), bit, np.int32))
        planes.append(containers(slot[has], counts))
        bit += 1
    none = np.zeros(0, np.int64)
    of, bits = np.concatenate([none, *of]), np.concatenate([none, *bits]).astype(np.int32)
    planes = pa.concat_arrays([pa.array([], pa.binary()), *planes])
    order = pa.array(np.lexsort((bits, of)))
    struct = pa.StructArray.from_arrays([pa.array(bits).take(order), planes.take(order)], ["bit", "docs"])
    ends = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(starts)))))
    docs = containers(slot, sizes)
    # links of a pair: its documents, and those of every plane with the weight of its bit
    n_links = population(docs) + np.bincount(of, population(planes) * (1 << bits.astype(np.int64)), len(starts)).astype(np.int64)
    return {"a": pa.array((key[starts] // n_b).astype(np.int32)), "b": pa.array((key[starts] % n_b).astype(np.int32)),
            "docs": docs, "n_docs": pa.array(population(docs).astype(np.int64)), "links": pa.array(n_links.astype(np.int64)),
            "planes": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct)}


# --- stages ----------------------------------------------------------------------

_DOCUMENT = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_POSTING = "a int, b int, docs binary, n_docs long, links long, planes array<struct<bit:int,docs:binary>>"


def inverted(docs: DataFrame, paths: tuple[str | None, str | None]) -> DataFrame:
    """Two kinds of rows from one pass: ``block, slot, doc_id`` with the
    document's numbers, and ``block`` with a pair's posting (``slot`` is null)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"block long, slot int, doc_id {kind}, {_DOCUMENT}, {_POSTING}"

    def each(batches):
        aligner = worker_aligner(*paths)
        number = TaskContext.get().partitionId() << 32
        arrow = None

        def block(ids: pa.Array, texts: list) -> pa.RecordBatch:
            found = aligner.align(texts)
            rows = {"n_a": [], "n_b": [], "n_groups": [], "n_links": [], "groups_sha256": []}
            for f in found:
                if f is None:
                    for name, value in zip(rows, (0, 0, 0, 0, "")):
                        rows[name].append(value)
                    continue
                for name in ("n_a", "n_b", "n_groups", "n_links"):
                    rows[name].append(int(getattr(aligner, name)[f].sum()))
                line = ";".join([aligner.groups[i] for i in f.tolist()])
                rows["groups_sha256"].append(hashlib.sha256(line.encode("ascii")).hexdigest())
            posts = postings(*aligner.links(found), len(aligner.b_bytes))
            n, m = len(texts), len(posts["a"])
            columns = {"block": pa.array(np.full(n + m, number)), "slot": pa.array(np.arange(n, dtype=np.int32)),
                       "doc_id": ids, **{c: pa.array(v) for c, v in rows.items()}, **posts}
            full = []
            for field in arrow:
                column = columns[field.name]
                if field.name != "block":
                    gap = pa.nulls(m if len(column) == n and field.name not in posts else n, field.type)
                    parts = [gap, column.cast(field.type)] if field.name in posts else [column.cast(field.type), gap]
                    column = pa.concat_arrays(parts)
                full.append(column)
            return pa.RecordBatch.from_arrays(full, [field.name for field in arrow])

        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            if arrow is None:
                arrow = pa.schema([
                    ("block", pa.int64()), ("slot", pa.int32()), ("doc_id", ids.type), ("n_a", pa.int64()),
                    ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                    ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.binary()), ("n_docs", pa.int64()),
                    ("links", pa.int64()),
                    ("planes", pa.list_(pa.struct([("bit", pa.int32()), ("docs", pa.binary())])))])
            at = 0
            while at < len(texts):
                past, size = at, 0
                while past < len(texts) and past - at < BLOCK_DOCUMENTS and (past == at or size < BLOCK_CHARACTERS):
                    size += len(texts[past] or "")
                    past += 1
                yield block(ids.slice(at, past - at), texts[at:past])
                number += 1
                at = past

    return docs.mapInArrow(each, schema)


def returned(rows: DataFrame) -> DataFrame:
    """``block, slot, n_best, count_sum`` from postings with their pair's
    ``count`` and ``best``; rows come sorted by block."""

    def each(batches):
        block, sums, best = None, None, None

        def done():
            slots = np.flatnonzero(sums)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slots), block)), pa.array(slots.astype(np.int32)), pa.array(best[slots]),
                 pa.array(sums[slots])], ["block", "slot", "n_best", "count_sum"])

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                if block != blocks[lo]:
                    if block is not None:
                        yield done()
                    block = int(blocks[lo])
                    sums, best = np.zeros(BLOCK_DOCUMENTS, np.int64), np.zeros(BLOCK_DOCUMENTS, np.int64)
                part = batch.slice(lo, hi - lo)
                count = part.column("count").to_numpy()
                highest = part.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
                row, slot = members(part.column("docs"))
                np.add.at(sums, slot, count[row])
                np.add.at(best, slot, highest[row])
                planes = part.column("planes")
                pair = np.repeat(np.arange(len(part)), planes.value_lengths().to_numpy())
                flat = planes.flatten()
                weight = np.left_shift(1, flat.field("bit").to_numpy().astype(np.int64))
                row, slot = members(flat.field("docs"))
                np.add.at(sums, slot, (count[pair] * weight)[row])
                np.add.at(best, slot, (highest[pair] * weight)[row])
        if block is not None:
            yield done()

    return rows.mapInArrow(each, "block long, slot int, n_best long, count_sum long")


class Alignment:
    """Both tokenizers over ``docs``.

    ``documents``: a row for each row; ``postings``: a row for each block and
    pair; ``pairs``: ``a, b, n_docs, count, best`` of every pair of ids that is
    linked anywhere, ``best`` if no pair with its B id has a higher count.
    """

    def __init__(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 bytes_path: str | None = None, pieces_path: str | None = None):
        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        both = stored(inverted(rows, (bytes_path, pieces_path)), "alignment")
        self.documents = both.where("slot is not null").select(
            "block", "slot", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        self.postings = both.where("slot is null").select("block", "a", "b", "docs", "n_docs", "links", "planes")
        counted = stored(self.postings.groupBy("a", "b").agg(
            F.sum("n_docs").alias("n_docs"), F.sum("links").alias("count")), "pairs")
        highest = counted.groupBy("b").agg(F.max("count").alias("highest"))
        self.pairs = counted.join(highest, "b").select(
            "a", "b", "n_docs", "count", (F.col("count") == F.col("highest")).alias("best"))

    def scores(self) -> DataFrame:
        """``doc_id`` and the documents' numbers, with those the postings return."""
        # pairs grow with the corpus: the same join at every size, which AQE splits where a pair is everywhere
        told = self.postings.select("block", "a", "b", "docs", "planes").join(
            self.pairs.select("a", "b", "count", "best").hint("merge"), ["a", "b"])
        told = told.select("block", "docs", "planes", "count", "best").repartition("block").sortWithinPartitions("block")
        back = returned(told)
        none = F.lit(0).cast("long")
        return self.documents.join(back, ["block", "slot"], "left").select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
            F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")


def align(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    Null and empty texts, and those that a tokenizer doesn't give back byte by
    byte, have no tokens: zeros, and an empty digest; they count nowhere. Rows
    that repeat count each. Texts are taken whole; a text longer than a block is
    a block. Further columns are not looked at; an empty table gives no rows.
    """
    return Alignment(docs, **options).scores()


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
