"""Benchmark decontamination by n-grams of words.

The n-grams of the test items become a set of hashes that travels with the plan
as a bitmap, sized by their number within a bound. One scan of the documents
looks up every window of words; the few that pass are compared with the n-grams
themselves in a join on the words. Everything is built from DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import LOWER, UPPER, once
from gatewright.session import stored

# Everything of ASCII that no word holds.
GAPS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
# The words where A-Z are not yet folded.
CASED_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NGRAM = 10
# The bitmap: bytes of seven bits, with 64 slots or more for each n-gram up to
# 4 MiB. Fuller ones let more windows through to the exact comparison and lose
# nothing. Its bytes come to the driver in pages.
SLOT_BYTES = 1 << 22
SLOT_BITS, SLOTS_EACH = 7, 64
PAGE_BYTES = 256


def words_of(text: Column) -> Column:
    """Words with A-Z in lower case; a null text has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + GAPS, LOWER + " " * len(GAPS))
    return F.array_remove(F.split(plain, " "), "")


def item_ngrams(items: DataFrame, n: int = NGRAM, *, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(ngram, len, items)``: each n-gram once, with the ids of the items that
    hold it, as text. An item of fewer words, but not none, is one n-gram."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    rows = once(rows, words=words_of(F.col("text"))).where(F.size("words") > 0)
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - (n - 1), F.lit(1))),
                          lambda i: F.slice("words", i, n))
    each = rows.select("item", F.explode(windows).alias("ngram"))
    return each.groupBy("ngram").agg(F.sort_array(F.collect_set("item")).alias("items")).select(
        "ngram", F.size("ngram").alias("len"), "items")


def _slot(words: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(words), F.lit(size * SLOT_BITS))


def bitmap_bytes(ngrams: int) -> int:
    """The size for so many n-grams: a power of two, ``SLOT_BYTES`` at most."""
    size = 1
    while size < SLOT_BYTES and size * SLOT_BITS < ngrams * SLOTS_EACH:
        size *= 2
    return size


def bitmap(ngrams: DataFrame) -> bytes:
    """The set of the n-grams' hashes, with seven slots in a byte: at most
    ``SLOT_BYTES`` come to the driver, however many n-grams there are."""
    size = bitmap_bytes(ngrams.count())
    slot = _slot(F.col("ngram"), size)
    byte = F.floor(slot / SLOT_BITS).cast("int")
    rows = ngrams.select(byte.alias("at"), F.pow(F.lit(2), F.pmod(slot, F.lit(SLOT_BITS))).cast("int").alias("bit"))
    page = F.floor(F.col("at") / PAGE_BYTES).cast("int")
    pages = rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).groupBy(page.alias("page")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("at") % PAGE_BYTES, "bits"))).alias("set"))
    each = F.transform(F.sequence(F.lit(0), F.lit(PAGE_BYTES - 1)), lambda i: F.lpad(
        F.hex(F.coalesce(F.try_element_at("set", i), F.lit(0))), 2, "0"))
    bits = bytearray(max(size, PAGE_BYTES))
    for row in pages.select("page", F.unhex(F.array_join(each, "")).alias("content")).collect():
        bits[row["page"] * PAGE_BYTES:(row["page"] + 1) * PAGE_BYTES] = row["content"]
    return bytes(bits[:size])


def _may_hold(bits: bytes, slot: Column) -> Column:
    byte = F.ascii(F.substring(F.lit(bits), F.floor(slot / SLOT_BITS).cast("int") + 1, F.lit(1)).cast("string"))
    return F.getbit(byte, F.pmod(slot, F.lit(SLOT_BITS)).cast("int")) == 1


def text_key(text: Column) -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def scan(docs: DataFrame, ngrams: DataFrame, n: int = NGRAM, *, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``(doc_id, th, n_words, pos, ngram)``: for every row one without ``pos``,
    and one for each window whose hash is in the set, with its place and words.

    Generators stand in for functions on arrays, whose elements Spark interprets
    one by one: so the words of a row are compiled code from the text to the bitmap.
    """
    bits = bitmap(ngrams)
    short = [r["len"] for r in ngrams.where(F.col("len") < n).select("len").distinct().collect()]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = once(rows.withColumn("th", text_key(F.col("text"))), words=words_of(F.col("text"))).drop("text")
    # no length: the row itself; at most n lengths of windows
    rows = rows.withColumn("size", F.explode(F.array(*map(F.lit, (0, n, *sorted(short))))))
    last = F.size("words") - (F.col("size") - 1)
    starts = F.when(F.col("size") == 0, F.array(F.lit(0))).when(last >= 1, F.sequence(F.lit(1), last)).otherwise(
        F.array().cast("array<int>"))
    rows = rows.withColumn("i", F.explode(starts))
    window = F.when(F.col("size") > 0, F.slice("words", F.col("i"), F.col("size")))
    rows = once(rows, slot=_slot(window, len(bits))).where((F.col("size") == 0) | _may_hold(bits, F.col("slot")))
    return rows.select("doc_id", "th", F.size("words").cast("long").alias("n_words"),
                       F.when(F.col("size") > 0, F.col("i") - 1).alias("pos"), window.alias("ngram"))


def hits(scanned: DataFrame, ngrams: DataFrame) -> DataFrame:
    """``(doc_id, th, n_hit, items, spans)`` of the rows with verified windows;
    ``spans`` are maximal runs of hit words, as (first, past)."""
    each = scanned.where("pos is not null").select("doc_id", "th", "pos", "ngram").distinct()
    true = each.join(ngrams, "ngram").select("doc_id", "th", "pos", "len", "items")
    by_row = true.groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_set(F.struct("pos", (F.col("pos") + F.col("len")).alias("past")))).alias("windows"),
        F.collect_set("items").alias("lists"))
    empty = F.array().cast("array<struct<first:int,past:int>>")
    start = F.struct(empty.alias("done"), F.lit(-1).alias("first"), F.lit(-1).alias("past"))

    def closed(acc):
        last = F.array(F.struct(acc.first.alias("first"), acc.past.alias("past")))
        return F.when(acc.first < 0, acc.done).otherwise(F.concat(acc.done, last))

    def add(acc, w):
        touches = w.pos <= acc.past
        return F.when(touches, F.struct(acc.done.alias("done"), acc.first.alias("first"),
                                        F.greatest(acc.past, w.past).alias("past"))).otherwise(
            F.struct(closed(acc).alias("done"), w.pos.alias("first"), w.past.alias("past")))

    spans = F.aggregate("windows", start, add, closed)
    by_row = by_row.select("doc_id", "th", spans.alias("spans"),
                           F.sort_array(F.array_distinct(F.flatten("lists"))).alias("items"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s.past - s.first).cast("long"))
    return by_row.withColumn("n_hit", n_hit)


def contamination(docs: DataFrame, items: DataFrame, n: int = NGRAM) -> DataFrame:
    """``doc_id, th, n_words, n_hit, items, contaminated`` for every row.

    Null and empty texts have no words; repeated rows come out as often as they
    went in and each with its own hits; an item without words never hits; with
    no items all rows are clean; other columns are not looked at.
    """
    ngrams = stored(item_ngrams(items, n), "ngrams")
    scanned = stored(scan(docs, ngrams, n), "windows")
    found = hits(scanned, ngrams).select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "n_hit", "items")
    rows = scanned.where("pos is null").drop("pos", "ngram")
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left")
    return rows.select("doc_id", "th", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                       F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                       F.col("n_hit").isNotNull().alias("contaminated"))


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def remove(docs: DataFrame, items: DataFrame, n: int = NGRAM, *, whole: bool = False) -> DataFrame:
    """``docs`` without the contaminated documents (``whole``) or without the
    hit words in them, all other columns as they are.

    A run of hit words goes with what stands between them; a line feed takes its
    place, so that the words around it stay apart. ``n_chars``, where there is
    one, follows the text.
    """
    ngrams = stored(item_ngrams(items, n), "ngrams")
    found = stored(hits(scan(docs, ngrams, n), ngrams), "hits").select(
        F.col("doc_id").alias("__d"), F.col("th").alias("__t"), F.col("spans").alias("__spans"))
    at = docs["doc_id"].eqNullSafe(F.col("__d")) & (text_key(docs["text"]) == F.col("__t"))
    if whole:
        return docs.join(found, at, "left_anti")
    rows = docs.join(found, at, "left")
    # every word with what follows it; what comes before the first word is the first gap
    words = F.regexp_extract_all(F.col("text"), F.lit(CASED_WORDS), 0)
    gaps = F.split(F.col("text"), CASED_WORDS)
    pairs = F.zip_with(words, F.slice(gaps, 2, F.greatest(F.size(gaps) - 1, F.lit(0))),
                       lambda w, g: F.struct(w.alias("w"), g.alias("g")))
    rows = once(rows, __pairs=F.when(F.col("__spans").isNotNull(), F.struct(gaps[0].alias("head"), pairs.alias("rest"))))

    def piece(p, i):
        hit = F.exists("__spans", lambda s: (s.first <= i) & (i < s.past))
        last = F.exists("__spans", lambda s: i + 1 == s.past)
        return F.when(last, F.lit("\n")).when(hit, F.lit("")).otherwise(F.concat(p.w, p.g))

    cut = F.concat(F.col("__pairs.head"), F.array_join(F.transform("__pairs.rest", piece), ""))
    clean = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut)
    out = rows.withColumn("text", clean)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(
            F.char_length("text").cast(kind)))
    return out.select(*docs.columns)


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP3_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i + 9])) AS g
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(g) AS n FROM grams),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes),
hits AS (
  SELECT doc_id, i, n, item_id
  FROM (SELECT doc_id, i, n, w[i:i + n - 1] AS g FROM places) JOIN grams USING (g)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
