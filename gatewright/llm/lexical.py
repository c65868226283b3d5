"""Ranked lexical search over a tree of documents.

Documents are restricted to the terms that some item asks for, and their terms
put in order of frequency. Written so, many begin alike: each task arranges its
documents in a prefix tree whose nodes share these beginnings. A node holds the
largest tf of each term in its subtree and the smallest m; both make a score
larger, so together they bound every score below. Each item searches the tree
depth first, the best bound first, and leaves out what cannot enter its list.

Items come in blocks of a bounded number of terms; a block is one scan.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gatewright.llm.common import LOWER, UPPER, ship, table
from gatewright.session import stored

ship(__name__)

TOP = 10
# Different terms of the items in one block: their tf maxima are a node's size.
BLOCK_TERMS = 16_384
# Documents and postings of one tree, and documents in one of its leaves.
TREE_DOCUMENTS, TREE_POSTINGS, LEAF = 8_192, 1 << 22, 32
# Parts in which the lists of one item are shortened before they meet.
PARTS = 64


def _separators() -> bytes:
    """Bytes in a text to bytes of terms: A-Z in lower case, blanks for all ASCII but letters and digits."""
    kept = LOWER.encode() + b"0123456789"
    to = bytearray(b if b >= 0x80 or b in kept else 0x20 for b in range(256))
    for a, b in zip(UPPER.encode(), LOWER.encode()):
        to[a] = b
    return bytes(to)


FOLD = _separators()


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other letters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split(b" ") if text else []


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, term)``, each once; rows that share an id are one item."""
    named = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    kind = named.schema["item_id"].dataType.simpleString()

    def each(batches):
        for batch in batches:
            found = [sorted({t for t in terms(x) if t}) for x in batch.column("text").to_pylist()]
            rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(rows)), pa.array([t for f in found for t in f], pa.binary())],
                ["item_id", "term"])

    return named.mapInArrow(each, f"item_id {kind}, term binary").distinct()


def blocks(rows: DataFrame, most: int):
    """Blocks ``(item ids, terms of each)`` of the items, with at most ``most``
    terms in all unless one item alone has more. One block at a time is on the driver."""
    lists = rows.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    held, size = [], 0
    for row in lists.orderBy("item_id").toLocalIterator():
        if held and size + len(row.terms) > most:
            yield held
            held, size = [], 0
        held.append((row.item_id, [bytes(t) for t in row.terms]))
        size += len(row.terms)
    if held:
        yield held


def restricted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, t, tf``: the number of terms of each row, and those of the
    vocabulary with their numbers of occurrences. Rows without any term have none."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(batches):
        for batch in batches:
            sizes, numbers, counts, ends = [], [], [], [0]
            for text in batch.column("text").to_pylist():
                words = terms(text)
                sizes.append(len(words) - words.count(b""))
                found = [i for i in map(vocabulary.get, words) if i is not None]
                t, tf = np.unique(np.array(found, np.int32), return_counts=True)
                numbers.append(t)
                counts.append(tf)
                ends.append(ends[-1] + len(t))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, d), *x]).astype(d)))
                     for x, d in ((numbers, np.int32), (counts, np.int64))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "t", "tf"])

    return docs.mapInArrow(each, f"doc_id {kind}, n long, t array<int>, tf array<long>")


def part_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class DocumentTree:
    """A prefix tree over documents given as flat postings.

    ``order`` tells each term's place in the order of frequency. Documents are
    sorted by their terms in that order, so that a node is a range of them:
    ``lo, hi`` with the tf maxima ``most`` (one for each term of the vocabulary),
    the least ``m`` and the children. A node of up to ``LEAF`` documents, or a run
    of such siblings, is a leaf.
    """

    def __init__(self, order: np.ndarray, ends: np.ndarray, t: np.ndarray, tf: np.ndarray, m: np.ndarray):
        docs = len(m)
        sizes = np.diff(ends)
        place = order[t]
        by_place = np.lexsort((place, np.repeat(np.arange(docs), sizes)))
        t, tf, place = t[by_place], tf[by_place], place[by_place]
        paths = [place[a:b].astype(">u4").tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        self.rows = np.array(sorted(range(docs), key=paths.__getitem__), np.int64)
        self.paths = [paths[i] for i in self.rows.tolist()]
        sizes = sizes[self.rows]
        self.ends = np.concatenate(([0], np.cumsum(sizes)))
        pick = np.repeat(ends[:-1][self.rows] - self.ends[:-1], sizes) + np.arange(self.ends[-1])
        self.t, self.tf, self.m = t[pick], tf[pick], m[self.rows]
        self.width = len(order)
        self.nodes: list[tuple[int, int, list[int]]] = []
        self.most: list[np.ndarray] = []
        self.least: list[int] = []
        self._build()
        self.most_of = np.stack(self.most)
        self.least_of = np.array(self.least, np.int64)

    def _leaf(self, lo: int, hi: int) -> int:
        most = np.zeros(self.width, np.int64)
        a, b = self.ends[lo], self.ends[hi]
        np.maximum.at(most, self.t[a:b], self.tf[a:b])
        return self._node(lo, hi, [], most, int(self.m[lo:hi].min()))

    def _node(self, lo, hi, children, most, least) -> int:
        self.nodes.append((lo, hi, children))
        self.most.append(most)
        self.least.append(least)
        return len(self.nodes) - 1

    def _children(self, lo: int, hi: int, depth: int) -> tuple[int, list[tuple[int, int]]]:
        """How far the documents lo..hi go together, and the ranges behind that."""
        first, last = self.paths[lo], self.paths[hi - 1]
        size = min(len(first), len(last))
        while depth < size and first[depth:depth + 4] == last[depth:depth + 4]:
            depth += 4
        cuts = [lo]
        for i in range(lo + 1, hi):
            if self.paths[i][depth:depth + 4] != self.paths[i - 1][depth:depth + 4]:
                cuts.append(i)
        return depth, list(zip(cuts, [*cuts[1:], hi]))

    def _build(self) -> None:
        """Nodes after their children, without recursion."""
        stack = [(0, len(self.m), 0, None, [])]
        done: list[int] = []
        while stack:
            lo, hi, depth, waiting, made = stack.pop()
            if waiting is None:
                depth, ranges = self._children(lo, hi, depth) if hi - lo > LEAF else (depth, [])
                if len(ranges) < 2:  # small, or all the same
                    done.append(self._leaf(lo, hi))
                    continue
                # small neighbours are one leaf
                waiting, run = [], None
                for a, b in ranges:
                    if b - a > LEAF:
                        waiting.append((a, b))
                        run = None
                    elif run is not None and b - waiting[run][0] <= LEAF:
                        waiting[run] = (waiting[run][0], b)
                    else:
                        waiting.append((a, b))
                        run = len(waiting) - 1
            elif made is not None:
                made.append(done.pop())
            if waiting:
                a, b = waiting.pop()
                stack.append((lo, hi, depth, waiting, made))
                stack.append((a, b, depth, None, []))
            elif len(made) == 1:
                done.append(made[0])
            else:
                most = np.maximum.reduce([self.most[c] for c in made])
                done.append(self._node(lo, hi, made, most, min(self.least[c] for c in made)))
        self.root = done.pop()

    def search(self, item: np.ndarray, weights: np.ndarray, ids: list, best: list, place: np.ndarray,
               top: int = TOP) -> None:
        """Put the documents into ``best``, a heap of (score, backwards id, id), that belong to the first ``top``.

        ``item`` are the item's terms, ``weights`` theirs; ``place`` is a scratch
        array over the vocabulary, -1 everywhere.
        """
        def bounds(nodes):
            tf = self.most_of[np.ix_(nodes, item)]
            return (weights * part_score(tf, self.least_of[nodes][:, None])).sum(axis=1)

        place[item] = np.arange(len(item))
        stack = [(int(bounds(np.array([self.root]))[0]), self.root)]
        while stack:
            bound, node = stack.pop()
            if bound <= 0 or (len(best) == top and bound < best[0][0]):
                continue
            lo, hi, children = self.nodes[node]
            if children:
                below = bounds(np.array(children))
                order = np.argsort(below, kind="stable")  # the best comes off the stack first
                stack += [(int(below[i]), children[i]) for i in order.tolist()]
                continue
            a, b = self.ends[lo], self.ends[hi]
            at = place[self.t[a:b]]
            hit = np.flatnonzero(at >= 0)
            if not len(hit):
                continue
            row = np.searchsorted(self.ends[lo + 1:hi + 1], hit + a, side="right") + lo
            parts = weights[at[hit]] * part_score(self.tf[a:b][hit], self.m[row])
            begins = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            for doc, score in zip(row[begins].tolist(), np.add.reduceat(parts, begins).tolist()):
                if score > 0:
                    doc_id = ids[self.rows[doc]]
                    entry = (score, Backwards(doc_id), doc_id)
                    if len(best) < top:
                        heapq.heappush(best, entry)
                    elif entry[:2] > best[0][:2]:
                        heapq.heapreplace(best, entry)
        place[item] = -1


class Backwards:
    """An id that counts as the greater the smaller it is; none is the smallest of all."""

    __slots__ = ("id",)

    def __init__(self, doc_id):
        self.id = doc_id

    def __eq__(self, other):
        return self.id == other.id

    def __lt__(self, other):
        if self.id is None or other.id is None:
            return self.id is None and other.id is not None
        return self.id > other.id


def best_of_tasks(vectors: DataFrame, items: list[np.ndarray], order: np.ndarray, weights: np.ndarray,
                  total_docs: int, total_terms: int, top: int) -> DataFrame:
    """``item, part, doc_id, score``: each task's first documents for every item."""
    kind = vectors.schema["doc_id"].dataType.simpleString()
    item_weights = [weights[x] for x in items]

    def each(batches):
        best: list[list] = [[] for _ in items]
        place = np.full(len(order), -1, np.int64)

        def grow(held):
            for at in range(0, len(held), TREE_DOCUMENTS):
                rows = held.slice(at, TREE_DOCUMENTS).combine_chunks()
                n = rows.column("n").to_numpy()
                lists = [rows.column(c).combine_chunks() for c in ("t", "tf")]
                ends = np.concatenate(([0], np.cumsum(lists[0].value_lengths().to_numpy())))
                t, tf = (x.flatten().to_numpy() for x in lists)
                m = 10 + (90 * n * total_docs) // total_terms
                tree = DocumentTree(order, ends, t.astype(np.int64), tf, m)
                ids = rows.column("doc_id").to_pylist()
                for item, w, found in zip(items, item_weights, best):
                    tree.search(item, w, ids, found, place, top)

        held, postings = [], 0
        for batch in batches:
            held.append(batch)
            postings += pa.compute.sum(pa.compute.list_value_length(batch.column("t"))).as_py() or 0
            if sum(b.num_rows for b in held) >= TREE_DOCUMENTS or postings >= TREE_POSTINGS:
                grow(pa.Table.from_batches(held))
                held, postings = [], 0
        if any(b.num_rows for b in held):
            grow(pa.Table.from_batches(held))
        rows = [(i, e[2], e[0]) for i, found in enumerate(best) for e in found]
        part = TaskContext.get().partitionId() % PARTS
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([part] * len(rows), pa.int32()),
             pa.array([r[1] for r in rows], id_type), pa.array([r[2] for r in rows], pa.int64())],
            ["item", "part", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(vectors.schema["doc_id"].dataType)
    return vectors.where(F.size("t") > 0).mapInArrow(each, f"item int, part int, doc_id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` rows of ``docs`` for every item.

    Scores as in the module's query. Equal scores rank by ascending id, a null
    id last. Rows of ``docs`` that repeat are ranked each. Rows of ``items``
    with one id are one item that asks for all their terms; an item without a
    term has no rows, nor has a search over no documents. Null texts have no
    terms; texts are taken whole; further columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    asked = stored(item_terms(items, item_col, item_text_col), "item-terms")
    item_kind = asked.schema["item_id"].dataType.simpleString()
    spark = docs.sparkSession
    out = None
    for block in blocks(asked, block_terms):
        found = stored(_search_block(rows, block, top, item_kind, spark), "ranked")
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = rows.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    return out


def _search_block(rows: DataFrame, block: list, top: int, item_kind: str, spark) -> DataFrame:
    names = sorted({t for _, found in block for t in found})
    vocabulary = {t: i for i, t in enumerate(names)}
    vectors = stored(restricted(rows, vocabulary), "term-vectors")
    total = vectors.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    counted = vectors.select(F.explode("t").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toArrow()
    df = np.zeros(len(names), np.int64)
    df[counted.column("t").to_numpy()] = counted.column("df").to_numpy()
    n_docs, n_terms = total.docs or 0, total.terms or 1
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    order = np.empty(len(names), np.int64)
    order[np.argsort(-df, kind="stable")] = np.arange(len(names))  # the most frequent first
    items = [np.array([vocabulary[t] for t in found], np.int64) for _, found in block]
    found = best_of_tasks(vectors, items, order, weights, n_docs, n_terms, top)
    # long lists of one item are shortened in parts before they meet
    first = W.partitionBy("item", "part").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    last = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= top)
    ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item int, item_id {item_kind}")
    # at most as many rows as a block has items
    return found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP12_SQL = rf"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS row, unnest(regexp_extract_all(
    translate(text, '{UPPER}', '{LOWER}'), '{_TERM}')) AS term FROM documents),
d AS (SELECT row, any_value(doc_id) AS doc_id, count(*) AS n FROM w GROUP BY row),
c AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_TERM}')) AS term
  FROM benchmark),
tf AS (SELECT row, term, count(*) AS tf FROM w SEMI JOIN q USING (term) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
s AS (
  SELECT item_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN weights USING (term) JOIN d USING (row), c GROUP BY item_id, row)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
       doc_id, score
FROM s JOIN d USING (row) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) <= {TOP}
"""
