"""Near copies by exact similarity of five-word shingles.

Two texts are near copies if the Jaccard similarity of their sets of shingles is
at least 4/5. Shingles have one order in all texts. Texts that are so similar
share a shingle among the first fifth of each (its prefix), and so many of them
that most pairs which only share a passage drop out by the count. What is left
is compared with whole sets. Frequent shingles come last in the order, so that
they seldom get into a prefix; that order is estimated from a sample, which
affects cost, never results.

SimHash goes first: texts whose fingerprints are a few bits apart are found by
``simhash.links`` and compared with whole sets. The prefixes then look for what
is similar beyond that, and leave out texts that hang together already.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import LOWER, UPPER, ship
from gatewright.llm.graph import components
from gatewright.llm.sieve import may_hold, sieve, sieved
from gatewright.llm.simhash import fingerprint, links, plan_partitions
from gatewright.session import SMALL_BATCHES, release, stored, work_scope, work_settings

ship(__name__)

SHINGLE = 5
# Documents in the sample for frequent shingles, how often one has to come in it, and how many travel.
SAMPLE, FREQUENT, MOST_FREQUENT = 20_000, 4, 65_536
# Texts with one shingle in their prefixes from which on they meet their middle one first.
LARGE_GROUP = 32
BLOCK = 1 << 17

SEED = 42
# Longs in a text's sketch.
SKETCH = 16


def shingles(text: str | None, size: int = SHINGLE) -> tuple[bytes, np.ndarray]:
    """``(key, hashes)``: 16 bytes for the words in lower case, and hashes of the distinct shingles.

    Fewer words than a shingle are one shingle; no words have none.
    """
    fold = bytes.maketrans(UPPER.encode(), LOWER.encode())
    words = (text or "").encode("utf-8", "surrogatepass").translate(fold).split()
    line = b" ".join(words)
    key = xxhash.xxh3_128_digest(line, SEED)
    if not words:
        return key, np.zeros(0, np.int64)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        hashes = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1:].tolist())]
    return key, np.unique(np.array(hashes, np.uint64).view(np.int64))


def prefix(hashes: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles in the order (count in the sample, hash): as many as
    make sure that a text of similarity 4/5 has one of them in its own prefix."""
    n = len(hashes)
    if not n:
        return hashes
    often = np.zeros(n, np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        often = np.where(frequent[at] == hashes, counts[at], 0)
    return hashes[np.lexsort((hashes, often))][:n - (4 * n + 4) // 5 + 1]


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Whether an odd number of the shingles fall on each bit. Bits that differ
    between two texts are no more than the shingles that only one of them has."""
    odd = np.bincount(hashes & (64 * SKETCH - 1), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(hashes: np.ndarray) -> np.ndarray:
    """As ``sketch``, with a bit at least for each shingle; none where ``sketch`` has that many.

    A sketch of fewer bits than shingles is filled by chance and rules nothing
    out, so that all long texts which share a passage would meet with whole sets.
    """
    if len(hashes) <= 64 * SKETCH:
        return np.zeros(0, np.int64)
    bits = 1 << (len(hashes) - 1).bit_length()
    odd = np.bincount(hashes & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def may_be_similar(a: Column, b: Column, na: Column, nb: Column) -> Column:
    """False only where sketches ``a`` and ``b`` of sets of sizes ``na`` and ``nb``
    rule similarity 4/5 out, which leaves a ninth of both sizes to differ at most."""
    differ = sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(SKETCH)), F.lit(0))
    return 9 * differ <= na + nb


def may_be_close(a: Column, b: Column, na: Column, nb: Column) -> Column:
    """As ``may_be_similar``, for wide sketches of sizes ``na <= nb`` of which the
    greater is a quarter more at most. The wider sketch, twice as wide then, is
    folded to the other's bits, which gives that text's sketch of so many bits."""
    size = F.size(a)

    def differ(n: Column, i: Column) -> Column:
        both = F.get(a, i).bitwiseXOR(F.get(b, i))
        return n + F.bit_count(F.when(F.size(b) > size, both.bitwiseXOR(F.get(b, i + size))).otherwise(both))

    return (size == 0) | (9 * F.aggregate(F.sequence(F.lit(0), F.greatest(size, F.lit(1)) - 1), F.lit(0), differ) <= na + nb)


def frequent_shingles(docs: DataFrame, text_col: str, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that come often in a sample, in order, with their counts; bounded."""
    total = docs.count()
    some = docs.select(F.col(text_col).alias("text"))
    if total > sample:
        some = some.sample(sample / total, 7)

    def each(batches):
        for batch in batches:
            found = [shingles(t)[1] for t in batch.column("text").to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["s"])

    rows = some.distinct().mapInArrow(each, "s long").groupBy("s").count().where(F.col("count") >= FREQUENT)
    with work_settings(docs.sparkSession):
        rows = rows.orderBy(F.desc("count"), "s").limit(MOST_FREQUENT).toArrow()
    s, n = rows.column("s").to_numpy(), rows.column("count").to_numpy()
    order = np.argsort(s)
    return s[order], n[order]


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text; a null one counts as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, th, words, n, prefix, fp, sketch, wide`` of every row: 16 bytes each for the
    text and for its words, the number of its shingles, its prefix, its SimHash
    fingerprint and its sketches."""
    frequent, counts = frequent_shingles(docs, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("th"),
                       F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def each(batches):
        for batch in batches:
            keys, sizes, firsts, fps, sketches, wide = [], [], [], [], [], []
            for text in batch.column("text").to_pylist():
                key, hashes = shingles(text)
                keys.append(key)
                sizes.append(len(hashes))
                firsts.append(prefix(hashes, frequent, counts))
                fps.append(fingerprint(text))
                sketches.append(sketch(hashes))
                wide.append(wide_sketch(hashes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(firsts, pa.list_(pa.int64())), pa.array(np.array(fps, np.uint64).view(np.int64)),
                 pa.array(sketches, pa.list_(pa.int64())), pa.array(wide, pa.list_(pa.int64()))],
                ["doc_id", "th", "words", "n", "prefix", "fp", "sketch", "wide"])

    return rows.mapInArrow(each, f"doc_id {kind}, th binary, words binary, n long, prefix array<long>, fp long, "
                                 "sketch array<long>, wide array<long>")


def sketched(nodes: DataFrame) -> DataFrame:
    """Pairs of ``nodes(k, fp)`` that SimHash links: of each fingerprint the
    smallest key with the others, and with those of fingerprints a few bits away."""
    first = stored(nodes.groupBy("fp").agg(F.min("k").alias("k")), "fingerprints")
    fps = first.select("fp")
    near = links(fps, plan_partitions(fps))
    near = near.join(first.toDF("a", "ka"), "a").join(first.toDF("b", "kb"), "b")
    same = nodes.select("fp", "k").join(first.toDF("fp", "least"), "fp").where("k <> least")
    return near.select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b")).unionByName(
        same.select(F.col("least").alias("a"), F.col("k").alias("b"))).distinct()


def _ends(column: np.ndarray) -> np.ndarray:
    """For every row the end of the run of equal rows it is in."""
    bounds = np.append(np.flatnonzero(column[1:] != column[:-1]) + 1, len(column))
    return np.repeat(bounds, np.diff(bounds, prepend=0))


PAIR, LARGE = 0, 1
MEETING = "kind int, a long, b long, na long, nb long"


def _meeting(kind: int, a, b, na, nb):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(a), kind, np.int32)), *(pa.array(np.asarray(x, np.int64)) for x in (a, b, na, nb))],
        ["kind", "a", "b", "na", "nb"])


def meetings(posts: DataFrame, large: int) -> DataFrame:
    """Pairs of ``posts(s, k, n, p, root)`` that share ``s``, the smaller key first.

    Left out are pairs whose sizes and places don't allow the similarity (what
    they share lies before ``s`` in both, is ``s``, or lies behind it in both),
    and those with one root. Without roots each text is its own.
    Of groups with more than ``large`` rows only ``s`` is told, as LARGE; no
    more than a block of such a group is held.
    """
    large = min(large, BLOCK - 1)
    if "root" not in posts.columns:
        posts = posts.withColumn("root", F.col("k"))

    def of(table):
        s, k, n, p, root = (table.column(c).to_numpy() for c in ("s", "k", "n", "p", "root"))
        end = _ends(s)
        begin = np.concatenate(([0], end[:-1]))
        begin = np.maximum.accumulate(np.where(begin == np.arange(len(s)), begin, 0))
        crowded = end - begin > large
        told = np.unique(s[crowded])
        if len(told):
            none = np.zeros(len(told), np.int64)
            yield _meeting(LARGE, told, told, none, none)
            s, k, n, p, root = (x[~crowded] for x in (s, k, n, p, root))
        if not len(s):
            return
        end, index = _ends(s), np.arange(len(s))
        count = end - index - 1
        total = np.cumsum(count)
        at = 0
        while at < len(s):
            past = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK, "right")))
            c = count[at:past]
            i = np.repeat(index[at:past], c)
            if len(i):
                j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
                shared = np.minimum(p[i], p[j]) + np.minimum(n[i] - p[i], n[j] - p[j])
                fits = (5 * np.minimum(n[i], n[j]) >= 4 * np.maximum(n[i], n[j])) & (9 * shared >= 4 * (n[i] + n[j]))
                fits &= root[i] != root[j]
                i, j = i[fits], j[fits]
                i, j = np.where(k[i] < k[j], i, j), np.where(k[i] < k[j], j, i)
                yield _meeting(PAIR, k[i], k[j], n[i], n[j])
            at = past

    def each(batches):
        held, count, told = [], 0, None
        for batch in batches:
            if told is not None:  # the rest of a large group
                s = batch.column("s").to_numpy()
                batch = batch.slice(int(np.searchsorted(s, told, "right")))
                if not batch.num_rows:
                    continue
                told = None
            held.append(batch)
            count += batch.num_rows
            if count < BLOCK:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            s = table.column("s").to_numpy()
            full = int(np.searchsorted(s, s[-1]))  # the last group may go on
            if full:
                yield from of(table.slice(0, full))
            rest = table.slice(full)
            if rest.num_rows > large:
                told = int(s[-1])
                yield _meeting(LARGE, [told], [told], [0], [0])
                held, count = [], 0
            else:
                held, count = rest.to_batches(), rest.num_rows
        if held:
            yield from of(pa.Table.from_batches(held).combine_chunks())

    return posts.repartition("s").sortWithinPartitions("s").mapInArrow(each, MEETING)


def crowded_posts(nodes: DataFrame, crowded: DataFrame) -> DataFrame:
    """``(s, k, n, p)`` of the posts of ``nodes`` with a shingle in ``crowded(s)``; the others don't move."""
    words = sieve(crowded, F.col("s"))

    def each(batches):
        for batch in batches:
            prefixes = batch.column("prefix")
            s, size = prefixes.flatten().to_numpy(), prefixes.value_lengths().to_numpy()
            p = np.arange(len(s)) - np.repeat(np.cumsum(size) - size, size)
            kept = np.flatnonzero(may_hold(words, s))
            of = np.repeat(np.arange(len(size)), size)[kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array(s[kept]), *(pa.array(batch.column(c).to_numpy()[of]) for c in ("k", "n")), pa.array(p[kept])],
                ["s", "k", "n", "p"])

    posts = nodes.select("k", "n", "prefix").mapInArrow(each, "s long, k long, n long, p long")
    return posts.join(crowded, "s")


def counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("kind", "a", "b").agg(F.count("*").alias("c"), F.first("na").alias("na"), F.first("nb").alias("nb"))


def promising(pairs: DataFrame) -> DataFrame:
    """Pairs whose number of shared shingles in the prefixes leaves similarity
    4/5 possible. Up to the end of the prefix that ends first all shared ones
    are counted (``c``, and at most ``spare`` in large groups); behind it are no
    more than that text has there."""
    behind = F.greatest(F.floor((4 * F.col("na") + 4) / 5), F.floor((4 * F.col("nb") + 4) / 5)) - 1
    return pairs.where(9 * (F.col("c") + F.col("spare") + behind) >= 4 * (F.col("na") + F.col("nb"))).select("a", "b")


def unruled(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that sketches don't rule out; whole sets, which are larger, meet only for these."""
    pairs = stored(pairs, "promising")  # so that Spark knows its size
    ends = nodes.select("k", "n", "sketch", "wide")
    both = pairs.join(ends.toDF("a", "na", "xa", "wa"), "a").join(ends.toDF("b", "nb", "xb", "wb"), "b")
    na, nb = F.col("na"), F.col("nb")
    small, great = (F.when(na <= nb, F.col(x)).otherwise(F.col(y)) for x, y in (("wa", "wb"), ("wb", "wa")))
    both = both.where((5 * F.least(na, nb) >= 4 * F.greatest(na, nb)) & may_be_similar(F.col("xa"), F.col("xb"), na, nb))
    return both.where(may_be_close(small, great, F.least(na, nb), F.greatest(na, nb))).select("a", "b")


def stars(often: DataFrame) -> DataFrame:
    """Each post of a large group with the one of about average size."""
    sizes = often.groupBy("s").agg(F.avg("n").alias("usual"))
    middle = often.join(sizes, "s").groupBy("s").agg(
        F.min_by(F.struct("k", "n", "p", "root"), F.struct(F.abs(F.col("n") - F.col("usual")), "k")).alias("m"))
    met = often.join(middle, "s").where(
        "root <> m.root and 5 * least(n, m.n) >= 4 * greatest(n, m.n) "
        "and 9 * (least(p, m.p) + least(n - p, m.n - m.p)) >= 4 * (n + m.n)")
    return met.select(F.least("k", "m.k").alias("a"), F.greatest("k", "m.k").alias("b")).distinct()


def unlinked(often: DataFrame) -> DataFrame:
    """Pairs of a large group with different roots that ``s`` may be the first to
    tie and that sketches don't rule out.

    If it is the first shared shingle, all that two texts share lies in the
    ``n - p`` shingles from it on, which limits the partner's size to ``reach``.
    Sizes meet before posts do, so that sizes out of reach cost nothing; posts
    then meet in a join, which splits a group over tasks. Sketches are compared
    inside it, so that texts which share just a passage never make a row;
    without sketches all sizes in reach do.
    """
    if "sketch" not in often.columns:
        often = often.withColumn("sketch", F.array_repeat(F.lit(0).cast("long"), SKETCH))
    if "wide" not in often.columns:
        often = often.withColumn("wide", F.array().cast("array<long>"))
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("int")  # a partner is one step away at most
    posts = often.withColumn("reach", F.floor(9 * (F.col("n") - F.col("p")) / 4) - F.col("n")).withColumn("step", step)
    sizes = posts.groupBy("s", "n", "step").agg(F.max("reach").alias("reach"))
    small = sizes.select("s", F.col("n").alias("n1"), F.col("reach").alias("r1"),
                         F.explode(F.array("step", F.col("step") + 1)).alias("step"))
    great = sizes.select("s", F.col("n").alias("n2"), F.col("reach").alias("r2"), "step")
    sizes = small.join(great, ["s", "step"]).where("n1 <= n2 and n2 <= r1 and n1 <= r2")
    sizes = sizes.select("s", F.explode(F.array("n1", "n2")).alias("n")).distinct()
    posts = posts.join(sizes, ["s", "n"], "left_semi")
    one = posts.select("s", F.col("n").alias("n1"), F.col("k").alias("k1"), F.col("root").alias("root1"),
                       F.col("reach").alias("r1"), F.col("sketch").alias("x1"), F.col("wide").alias("w1"),
                       F.explode(F.array("step", F.col("step") + 1)).alias("step"))
    two = posts.select("s", F.col("n").alias("n2"), F.col("k").alias("k2"), F.col("root").alias("root2"),
                       F.col("reach").alias("r2"), F.col("sketch").alias("x2"), F.col("wide").alias("w2"), "step")
    fits = F.expr("n1 <= n2 and n2 <= r1 and n1 <= r2 and (n1 < n2 or k1 < k2) and root1 <> root2")
    # in this order, so that long sketches are compared only where short ones rule nothing out
    n1, n2 = F.col("n1"), F.col("n2")
    met = one.join(two, ["s", "step"]).where(
        fits & may_be_similar(F.col("x1"), F.col("x2"), n1, n2) & may_be_close(F.col("w1"), F.col("w2"), n1, n2))
    return met.select(F.least("k1", "k2").alias("a"), F.greatest("k1", "k2").alias("b")).distinct()


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """``(a, b)`` of the pairs with a similarity of at least 4/5. Those that sketches rule out move no sets."""
    with work_scope() as made:
        pairs = stored(unruled(pairs, nodes), "pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
        # written, so that Spark knows its size before it decides how to join the texts
        ends = stored(nodes.select("k", "th").join(ends, "k", "left_semi").withColumnRenamed("th", "__th"), "ends")
        texts = docs.select(text_key(F.col(text_col)).alias("__key"), F.col(text_col).alias("text"))
        # only texts that may be among them move, and copies once for each task
        texts = sieved(texts, sieve(ends, F.xxhash64("__th")), F.xxhash64("__key")).dropDuplicates(["__key"])
        texts = texts.join(ends, F.col("__key") == F.col("__th")).select("k", "text")

        def each(batches):
            for batch in batches:
                found = [shingles(t)[1] for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(found, pa.list_(pa.int64()))], ["k", "set"])

        sets = stored(texts.mapInArrow(each, "k long, set array<long>"), "sets")
        both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
        shared = F.size(F.array_intersect("sa", "sb"))
        found = stored(both.where(9 * shared >= 4 * (F.size("sa") + F.size("sb"))).select("a", "b"), "links")
    release(docs.sparkSession, made, but=found)
    return found


def near_copies(docs: DataFrame, *, large: int = LARGE_GROUP, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``(doc_id, th, root)`` for every row: rows whose texts hang together by
    steps of similarity 4/5 or more share the root.

    Texts with the same words are one node. SimHash links come first. Where over
    ``large`` nodes share a shingle of their prefixes, each meets the one of
    middle size next; what is linked by that is not compared any more, all else
    that can be similar is, by sketches first and whole sets then.
    Rows without an id take part, null and empty texts are copies of each other,
    texts are taken whole; repeated rows come out as often as they went in;
    further columns are not looked at; an empty table gives no rows.
    """
    with work_scope() as made, work_settings(docs.sparkSession, SMALL_BATCHES):
        rows = stored(marked(docs, id_col, text_col), "prefixes")
        nodes = stored(rows.groupBy("words").agg(
            F.min("th").alias("th"), F.first("n").alias("n"), F.first("prefix").alias("prefix"),
            F.first("fp").alias("fp"), F.first("sketch").alias("sketch"), F.first("wide").alias("wide")).withColumn(
                "k", F.monotonically_increasing_id()), "nodes")
        rows = stored(rows.select("doc_id", "th", "words"), "rows")
    release(docs.sparkSession, made, but=rows.select("words").unionByName(nodes.select("words")))
    with work_scope() as made, work_settings(docs.sparkSession, SMALL_BATCHES):
        close = verified(sketched(nodes), nodes, docs, text_col)
        roots = stored(components(close).withColumnRenamed("node", "k"), "roots")
        posts = nodes.select("k", "n", "prefix").join(roots, "k", "left").select(
            "k", "n", F.coalesce("root", "k").alias("root"), F.posexplode("prefix").alias("p", "s")).select(
            "s", "k", "n", F.col("p").cast("long").alias("p"), "root")
        met = stored(counted(meetings(posts, large)), "meetings")
        pairs = met.where(F.col("kind") == PAIR).drop("kind")
        crowded = met.where(F.col("kind") == LARGE).select(F.col("a").alias("s"))
        if crowded.isEmpty():
            candidates = promising(pairs.withColumn("spare", F.lit(0)))
        else:
            often = crowded_posts(nodes, crowded).join(roots, "k", "left")
            often = stored(often.withColumn("root", F.coalesce("root", "k")), "crowded")
            close = close.unionByName(verified(stars(often), nodes, docs, text_col))
            roots = components(close).withColumnRenamed("node", "k")
            often = often.drop("root").join(roots, "k", "left").withColumn("root", F.coalesce("root", "k"))
            often = stored(often.join(nodes.select("k", "sketch", "wide"), "k"), "crowded")
            # shingles of large groups are not counted pair by pair
            known = stored(often.groupBy("k").agg(F.count("*").alias("n")).join(roots, "k", "full_outer"), "known")
            for side in ("a", "b"):
                pairs = pairs.join(known.toDF(side, f"extra_{side}", f"root_{side}"), side, "left")
            pairs = pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
            none = F.lit(0).cast("long")
            pairs = pairs.withColumn("spare", F.least(F.coalesce("extra_a", none), F.coalesce("extra_b", none)))
            candidates = promising(pairs).unionByName(unlinked(often)).distinct()
        linked = stored(verified(candidates, nodes, docs, text_col).unionByName(close), "linked")
        labels = stored(components(linked).withColumnRenamed("node", "k"), "labels")
    release(docs.sparkSession, made, but=labels)
    named = nodes.select("words", "k").join(labels, "k", "left").select("words", F.coalesce("root", "k").alias("root"))
    return rows.select("doc_id", "th", "words").join(named, "words").select("doc_id", "th", "root")


def keep_one(docs: DataFrame, *, large: int = LARGE_GROUP) -> DataFrame:
    """``docs`` with one row of each group of near copies: any with an id before
    those without, then that with the smallest doc_id and text hash.

    Rows that repeat that id and text are one row; null and empty texts are one
    group. All columns are kept as they are; an empty table gives no rows.
    """
    with work_scope() as made:
        rows = near_copies(docs, large=large).groupBy("root", "doc_id", "th").agg(F.count("*").alias("n"))
        rows = stored(rows, "classes")
        best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("k")
        kept = rows.groupBy("root").agg(best).select(
            "root", F.col("k.doc_id").alias("id"), F.col("k.th").alias("text_hash"))
        judged = stored(rows.join(kept, "root").select(
            F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "n",
            (F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("text_hash"))).alias("stays")), "kept")
    release(docs.sparkSession, made, but=judged)
    # rows that go, or are there more than once, are few next to those that stay
    other = judged.where("n > 1 or not stays").select("__id", "__th")
    twice = judged.where("n > 1 and stays").select("__id", "__th")

    def matching(rows, which, how):
        at = rows["doc_id"].eqNullSafe(which["__id"]) & (text_key(rows["text"]) == which["__th"])
        return rows.join(which, at, how)

    # a row whose text is not among those in question stays where it is
    key, words = F.xxhash64(text_key(docs["text"])), sieve(other, F.xxhash64("__th"))
    asked = sieved(docs, words, key)
    return sieved(docs, words, key, out=True).unionByName(matching(asked, other, "left_anti")).unionByName(
        matching(asked, twice, "left_semi").dropDuplicates(["doc_id", "text"]))
