"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint of 64 bits is cut into partitions. If the thresholds of the
partitions add up to ``radius - partitions + 1`` (-1 means: never look here),
any two fingerprints within ``radius`` bits are within the threshold in at
least one partition. Bits that go together are put into one partition, so that
the partitions differ in how well they tell fingerprints apart, and the
thresholds are dealt to the partitions where they cost least.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import LOWER, UPPER, ship
from gatewright.llm.graph import components
from gatewright.session import stored

ship(__name__)

BITS = 64
SEED = 42
# Partition counts that are compared, and what a probe costs next to a candidate pair.
PARTITIONS = (1, 2, 3, 4)
PROBE_COST = 4.0
# Buckets with more fingerprints are linked over their neighbours' midpoints.
LARGE_BUCKET = 512


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority bits of the shingles' hashes; no words give zero."""
    fold = bytes.maketrans(UPPER.encode(), LOWER.encode())
    words = (text or "").encode("utf-8", "surrogatepass").translate(fold).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        hashes = [xxhash.xxh64_intdigest(line[a:b], SEED)
                  for a, b in zip(starts, ends[shingle - 1:].tolist())]
    count = np.zeros(BITS, np.int64)
    hashes = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(hashes), 65536):
        count += np.unpackbits(hashes[at:at + 65536], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, th, fp)`` for every row: the text's hash, which tells rows of
    one id apart, and the fingerprint as a signed long.

    A null or blank text has fingerprint zero; fewer words than a shingle are
    one shingle; texts of any length are read whole.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"),
                       F.col(text_col).alias("text"))

    def each(batches):
        for batch in batches:
            values = [fingerprint(t) for t in batch.column("text").to_pylist()]
            fps = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), fps],
                                             ["doc_id", "th", "fp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(each, f"doc_id {kind}, th long, fp long")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have both bit i and bit j: 64 x 64 sums."""

    def each(batches):
        total, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint8)
            bits = np.unpackbits(fp.reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += len(bits)
            both += bits.T @ bits
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BITS * BITS + 1)),
             pa.array([*both.ravel().astype(np.int64).tolist(), total])], ["at", "n"])

    sums = fps.select("fp").mapInArrow(each, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    flat = np.zeros(BITS * BITS + 1)
    for row in sums.collect():  # always 4,097 rows
        flat[row["at"]] = row["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def correlations(total: int, both: np.ndarray) -> np.ndarray:
    share = np.diag(both) / max(total, 1)
    cov = both / max(total, 1) - np.outer(share, share)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    return np.abs(cov / np.outer(sd, sd))


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size: each group starts with the
    bit that is tied most to the bits left, and takes the bit tied most to it."""
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, groups))) // (parts - k)
        order = sorted(left)
        strength = correlation[np.ix_(order, order)].sum(1)
        group = [order[int(strength.argmax())]]
        left.discard(group[0])
        while len(group) < size:
            order = sorted(left)
            tied = correlation[np.ix_(order, group)].sum(1)
            group.append(order[int(tied.argmax())])
            left.discard(group[-1])
        groups.append(sorted(group))
    return groups


def part_key(group: list[int], fp="fp"):
    """The bits of a group, kept in place: a fingerprint with all others cleared."""
    mask = sum(1 << b for b in group)
    return F.col(fp).bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def ball(size: int, radius: int) -> int:
    """Keys within ``radius`` bits of a key of ``size`` bits."""
    return sum(math.comb(size, r) for r in range(radius + 1))


def pair_estimates(pairs: float, agree: np.ndarray, radius: int) -> list[float]:
    """Pairs within 0..radius bits of a partition. Those at 0 are counted; each
    further bit is scaled by the odds that it differs, bits taken as independent."""
    odds = (1 - agree) / np.maximum(agree, 1e-9)
    symmetric = np.zeros(radius + 1)
    symmetric[0] = 1
    for x in odds:
        symmetric[1:] += x * symmetric[:-1]
    return np.cumsum(pairs * symmetric).tolist()


def allocate(costs: list[list[float]], radius: int) -> tuple[float, list[int]]:
    """Thresholds, one of -1..radius for each partition, that add up to
    ``radius - partitions + 1`` at the least total cost: dynamic programming.
    ``costs[i][e + 1]`` is the cost of threshold e in partition i."""
    best = {0: (0.0, [])}
    for cost in costs:
        step = {}
        for used, (so_far, chosen) in best.items():
            for e in range(-1, radius + 1):
                value = so_far + cost[e + 1]
                if used + e not in step or value < step[used + e][0]:
                    step[used + e] = (value, [*chosen, e])
        best = step
    return best[radius - len(costs) + 1]


def plan_partitions(fps: DataFrame, radius: int = 2) -> list[tuple[list[int], int]]:
    """``(bits, threshold)`` of the partitions to search, for these fingerprints.

    Bucket sizes of every partitioning that is considered are counted over all
    fingerprints; only their sums of squares, ten numbers, and the 64 x 64 bit
    sums come to the driver.
    """
    total, both = bit_statistics(fps)
    tied = correlations(total, both)
    share = np.diag(both) / max(total, 1)
    agree = share ** 2 + (1 - share) ** 2
    choices = {m: group_bits(tied, m) for m in PARTITIONS}
    keyed = [F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), part_key(g).alias("key"))
             for m, groups in choices.items() for i, g in enumerate(groups)]
    sizes = fps.select(F.explode(F.array(*keyed)).alias("k")).groupBy("k.m", "k.i", "k.key").count()
    pairs = {(r["m"], r["i"]): r["pairs"] for r in sizes.groupBy("m", "i").agg(
        F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs")).collect()}
    best = None
    for m, groups in choices.items():
        costs = []
        for i, g in enumerate(groups):
            found = pair_estimates(max(pairs.get((m, i), 0.0), total ** 2 / 2 ** (len(g) + 1)),
                                   agree[g], radius)
            costs.append([0.0, *(PROBE_COST * total * (1 + ball(len(g), e)) + found[e] * (1 if e == 0 else 2)
                                 for e in range(radius + 1))])
        cost, chosen = allocate(costs, radius)
        if best is None or cost < best[0]:
            best = (cost, [(g, e) for g, e in zip(groups, chosen) if e >= 0])
    return best[1]


def _flips(group: list[int], radius: int) -> list[int]:
    masks = [sum(1 << b for b in bits) for r in range(radius + 1)
             for bits in itertools.combinations(group, r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, parts: list[tuple[list[int], int]], radius: int = 2,
          large: int = LARGE_BUCKET) -> DataFrame:
    """``(a, b)``, fingerprints at most ``radius`` bits apart, such that all
    that are linked hang together. ``fps`` holds every fingerprint once.

    Probes meet the index on (partition, key) and pairs are verified inside the
    join. Buckets over ``large`` fingerprints would give the square of their
    size, so what meets in such a bucket is linked exactly in another way: two
    fingerprints are within 2 bits if and only if some point is within 1 bit of
    both; each names the 65 points around it, and every point links those that
    name it to the smallest. That costs 65 rows for each fingerprint. At any
    other radius the members of a large bucket are compared pair by pair, which
    is as exact but costs the square of its size.
    """
    if radius != 2:
        # points serve for 2 bits only; at others all that meet are compared, in buckets of any size
        large = None
    index = [F.struct(F.lit(i).alias("part"), part_key(g).alias("key")) for i, (g, _) in enumerate(parts)]
    index = fps.select("fp", F.explode(F.array(*index)).alias("k")).select("fp", "k.part", "k.key")
    hot = None
    if large is not None:
        sizes = index.groupBy("part", "key").count()
        hot = stored(sizes.where(F.col("count") > large).select("part", "key"), "large-buckets")
    if all(e == 0 for _, e in parts):
        probes = index
    else:
        probes = None
        for i, (g, e) in enumerate(parts):
            keys = F.transform(F.lit(np.array(_flips(g, e), np.int64)), lambda m: part_key(g).bitwiseXOR(m))
            one = fps.select("fp", F.lit(i).alias("part"), F.explode(keys).alias("key"))
            probes = one if probes is None else probes.unionByName(one)
    a, b = probes.alias("a"), index.alias("b")
    some_hot = hot is not None and not hot.isEmpty()
    if some_hot:
        a = probes.join(hot, ["part", "key"], "left_anti").alias("a")
        b = index.join(hot, ["part", "key"], "left_anti").alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius
    order = F.col("a.fp") < F.col("b.fp") if all(e == 0 for _, e in parts) else F.col("a.fp") != F.col("b.fp")
    pairs = a.join(b, (F.col("a.part") == F.col("b.part")) & (F.col("a.key") == F.col("b.key"))
                   & order & near).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    if not some_hot:
        return pairs
    crowd = probes.join(hot, ["part", "key"], "left_semi").select("fp").unionByName(
        index.join(hot, ["part", "key"], "left_semi").select("fp")).distinct()
    points = F.lit(np.array(_flips(list(range(BITS)), 1), np.int64))
    named = crowd.select("fp", F.explode(F.transform(points, lambda m: F.col("fp").bitwiseXOR(m))).alias("at"))
    named = stored(named, "points")
    least = named.groupBy("at").agg(F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1")
    stars = named.join(least, "at").where("fp <> least").select(
        F.col("fp").alias("a"), F.col("least").alias("b")).distinct()
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, *, radius: int = 2, large: int = LARGE_BUCKET,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, th, fp, root, component_id)`` for every row: rows whose fingerprints are
    linked by steps of at most ``radius`` bits share the root, a fingerprint,
    and the smallest doc_id.

    Equal fingerprints are one node, so copies cost nothing after the first
    aggregation. Rows without an id take part; a group of only such rows has a
    null component. Repeated rows come out as often as they went in; an empty
    table gives an empty result; further columns are not looked at.
    """
    fps = stored(fingerprints(docs, id_col=id_col, text_col=text_col), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    only = nodes.select("fp")
    roots = components(links(only, plan_partitions(only, radius), radius, large))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "named")
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    labels = named.join(smallest, "root").select("fp", "root", "component_id")
    return fps.join(labels, "fp").select("doc_id", "th", "fp", "root", "component_id")


def unsigned_hex(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that with the
    smallest doc_id, and the smallest text hash where ids repeat.

    Rows that repeat that id and text are one row. Rows without an id are not
    compared and stay. All columns are kept as they are.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    rows = near_duplicates(known, radius=radius).groupBy("root", "doc_id", "th").agg(
        F.count("*").alias("n"))
    keep = stored(rows.groupBy("root").agg(F.min(F.struct("doc_id", "th", "n")).alias("k")).select(
        F.col("k.doc_id").alias("__kept_id"), F.col("k.th").alias("__kept_text"), "k.n"), "kept")

    def matching(which):
        at = (known["doc_id"] == which["__kept_id"]) & (F.xxhash64(known["text"]) == which["__kept_text"])
        return known.join(which, at, "left_semi")

    kept = matching(keep)
    if not keep.where("n > 1").isEmpty():
        kept = matching(keep.where("n = 1")).unionByName(
            matching(keep.where("n > 1")).dropDuplicates(["doc_id", "text"]))
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
