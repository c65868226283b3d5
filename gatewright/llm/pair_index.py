"""Byte-pair encoding through an index of pair occurrences, and decoding.

The distinct words of a stretch of rows lie one behind the other as symbols that
know their neighbours. An index maps every pair to all its positions in the
stretch. The ranks that occur are applied in ascending order, each at all its
positions at once; a merge replaces two symbols by one and puts the two pairs it
forms into the lists of their ranks. A merged symbol is younger than the merge
that made it, so its pairs have higher ranks: going up once is the same as
merging each word by its lowest rank, however long it is.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import types

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import ship, table

ship(__name__)

VOCABULARY = "byte_bpe_50k"
# Bytes of text that are split into words at a time, and words that a worker remembers.
STRETCH = 1 << 24
REMEMBERED = 1 << 20

EDGE, DEAD = -1, -2


def _letter_bytes() -> dict[str, int]:
    """The byte behind every letter of a byte-level vocabulary: printable ones
    stand for themselves, the others come in order from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PairIndexCoder:
    """Ids of texts and texts of ids, equal to those of a byte-level vocabulary
    file (without added special tokens, truncation or padding)."""

    def __init__(self, path: str | None = None):
        import public_tokenizers

        with open(path or public_tokenizers.path(f"{VOCABULARY}.json"), encoding="utf-8") as file:
            model = json.load(file)
        letters = _letter_bytes()
        vocab = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode("utf-8")
        self.first = np.zeros(256, np.int32)
        for letter, b in letters.items():
            self.first[b] = vocab[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int32)
        self.right = np.array([vocab[b] for _, b in merges], np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        keys = self._key(self.left, self.right)
        self.rank_order = np.argsort(keys)
        self.keys = keys[self.rank_order]
        self.words = regex.compile(public_tokenizers.PATTERN)
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.int64) << 32) | (b.astype(np.int64) & 0xFFFFFFFF)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair; -1 where it is never merged."""
        key = self._key(a, b)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_order[at], -1)

    def merge(self, symbols: np.ndarray) -> np.ndarray:
        """The flat symbols of words, ``EDGE`` around each, after all merges; ``DEAD`` where one was taken up."""
        n = len(symbols)
        after = np.arange(1, n + 1, dtype=np.int64)
        before = np.arange(-1, n - 1, dtype=np.int64)
        places: dict[int, list[np.ndarray]] = {}  # positions of every pair, by its rank
        heap: list[int] = []

        def enter(at: np.ndarray) -> None:
            rank = self.ranks(symbols[at], symbols[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, part in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts)):
                if r not in places:
                    places[r] = []
                    heapq.heappush(heap, r)
                places[r].append(part)

        enter(np.flatnonzero(symbols[:-1] != EDGE))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(places.pop(r)))
            a, b = self.left[r], self.right[r]
            at = at[(symbols[at] == a) & (symbols[after[at]] == b)]  # others were taken up meanwhile
            if a == b and len(at) > 1:
                # in a row of equal symbols every second pair, from the left
                starts = np.concatenate(([True], after[at[:-1]] != at[1:]))
                run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            symbols[at] = self.merged[r]
            symbols[gone] = DEAD
            after[at] = after[gone]
            before[after[at]] = at
            enter(np.unique(np.concatenate((before[at], at))))
        return symbols

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet, all at once."""
        if not words:
            return
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(d) for d in data])
        ends = np.cumsum(sizes + 1)  # places of the edges behind the words
        symbols = np.full(int(ends[-1]) + 1, EDGE, np.int32)
        inside = np.ones(len(symbols), bool)
        inside[0] = False
        inside[ends] = False
        symbols[inside] = self.first[np.frombuffer(b"".join(data), np.uint8)]
        symbols = self.merge(symbols)
        left = symbols != DEAD
        counts = np.cumsum(left)[ends] - np.arange(1, len(words) + 1)  # without the edges
        ids = symbols[left & inside].astype("<u4").tobytes()
        begin = 0
        # the edge at place 0 is counted too
        for word, past in zip(words, ((counts - 1) * 4).tolist()):
            self.known[word] = ids[begin:past]
            begin = past

    def pieces(self, text: str) -> list[str | int]:
        """Words, and ids of special tokens that the text spells out."""
        if self.split is None or not any(t in text for t in self.special):
            return self.words.findall(text)
        out: list[str | int] = []
        at = 0
        for m in self.split.finditer(text):
            out += self.words.findall(text[at:m.start()])
            out.append(self.special[m.group()])
            at = m.end()
        return out + self.words.findall(text[at:])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text; a null or empty one has none."""
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            past, size = at, 0
            while past < len(texts) and (past == at or size < STRETCH):
                size += len(texts[past] or "")
                past += 1
            out += self._stretch(texts[at:past])
            at = past
        return out

    def _stretch(self, texts: list[str | None]) -> list[np.ndarray]:
        pieces = [self.pieces(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        fresh: set[str] = set()
        for p in pieces:
            fresh.update(p)
        self.learn([w for w in fresh if isinstance(w, str) and w not in self.known])
        known = self.known
        marks = {i: np.array([i], "<u4").tobytes() for i in self.special.values()}
        out = []
        for p in pieces:
            try:
                data = b"".join(map(known.__getitem__, p))
            except KeyError:  # a special token among the words
                data = b"".join(marks[w] if isinstance(w, int) else known[w] for w in p)
            out.append(np.frombuffer(data, "<u4"))
        return out

    def decode(self, ids) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        table = self.bytes_of
        return b"".join([table[i] for i in np.asarray(ids).tolist()]).decode("utf-8", "replace")


def worker_coder(path: str | None = None) -> PairIndexCoder:
    """One coder for each vocabulary and Python worker."""
    kept = sys.modules.setdefault("_gatewright_worker", types.ModuleType("_gatewright_worker"))
    coders = kept.__dict__.setdefault("pair_coders", {})
    if path not in coders:
        coders[path] = PairIndexCoder(path)
    return coders[path]


def _kind(docs: DataFrame, column: str) -> str:
    return docs.schema[column].dataType.simpleString()


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, ids`` of every row.

    Null and empty texts have no ids; repeated rows stay repeated; texts are
    taken whole, and one long word costs no more than as many short ones. Other
    columns are not looked at; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def each(batches):
        coder = worker_coder(path)
        for batch in batches:
            ids = coder.encode(batch.column("text").to_pylist())
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate([np.zeros(0, "<u4"), *ids]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                ["doc_id", "ids"])

    return rows.mapInArrow(each, f"doc_id {_kind(rows, 'doc_id')}, ids array<int>")


def decode(encoded: DataFrame, *, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``; null ids give a null text."""

    def each(batches):
        coder = worker_coder(path)
        for batch in batches:
            texts = [None if x is None else coder.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(each, f"doc_id {_kind(rows, 'doc_id')}, text string")


def round_trip(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: the text is
    encoded and its ids decoded in the same task, so that no ids travel. Rows as in ``encode``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def each(batches):
        coder = worker_coder(path)
        names = [str(i) for i in range(len(coder.bytes_of))]
        for batch in batches:
            sizes, shas, decoded = [], [], []
            for ids in coder.encode(batch.column("text").to_pylist()):
                sizes.append(len(ids))
                line = ",".join([names[i] for i in ids.tolist()])
                shas.append(hashlib.sha256(line.encode("ascii")).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()),
                 pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(
        each, f"doc_id {_kind(rows, 'doc_id')}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11_pair_index(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
