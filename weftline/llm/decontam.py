"""Benchmark decontamination by winnowing, in DataFrame expressions alone.

A text's words are hashed in runs of five; of every six runs side by side, those with the least hash are its
fingerprints. Any ten words that a document shares with an item therefore share a fingerprint, at the same
place of the ten. Fingerprints are joined, and each hit fixes how item and document lie against each other; it is
extended by comparing every window of the item with the document's words at that place. So the result is exact.

Items of fewer than ten words have one window, the whole item; they are met by its hash at every place.

Candidates are kept by the hash of a document's text, so a null or repeated ``doc_id`` does no harm, and copies share
theirs. Each row of ``docs`` gives one row. A null text, or one without words, has no words and no hits. Items
without words have no window. ``item_id`` names an item: repeated rows count once, and a null one counts as one item
that the list of items leaves out. Other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.settings import written

WINDOW = 10
GRAM = 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of ``text`` with A-Z in lower case, and no other letter changed."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once a row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def grams(word_list: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` words."""
    return F.when(F.size(word_list) >= n, F.transform(F.sequence(F.lit(1), F.size(word_list) - (n - 1)), lambda i: F.xxhash64(F.slice(word_list, i, n)))).otherwise(F.array().cast("array<bigint>"))


def runs_of(n: int):
    return lambda word_list: grams(word_list, n)


def fingerprints(word_list: Column) -> Column:
    """Winnowed (hash, place) of a list of words; places count from 0."""
    span = WINDOW - GRAM + 1
    least = lambda part: F.array_position(part, F.array_min(part))
    places = lambda h: F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(h) - (span - 1)), lambda s: s + once(F.slice(h, s, span), least).cast("int") - 1))
    picked = lambda h: F.when(F.size(h) >= span, F.transform(places(h), lambda p: F.struct(F.element_at(h, p).alias("hash"), (p - 1).alias("place")))).otherwise(F.array().cast("array<struct<hash:bigint,place:int>>"))
    return once(grams(word_list, GRAM), picked)


MARK = "__hits"


def marked(docs: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``docs`` with a struct of n_words, n_hit and the sorted ids of the items met."""
    item = items.select(F.col(item_id).cast("string").alias("item_id"), words(F.col(text)).alias("item_words")).where("size(item_words) > 0").distinct()
    item = written(item.withColumn("item", F.xxhash64("item_id", "item_words")).withColumn("n", F.size("item_words")), "items")
    doc = docs.select(F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("doc"))

    long_items = written(item.where(F.col("n") >= WINDOW).select("item", F.inline(once(F.col("item_words"), fingerprints)).alias("hash", "at")), "item_prints")
    prints = doc.select("doc", F.inline(once(words(F.col("text")), fingerprints)).alias("hash", "place"))
    met = prints.join(long_items, "hash").select("doc", "item", (F.col("place") - F.col("at")).alias("shift"))
    for (n,) in item.where(F.col("n") < WINDOW).select("n").distinct().collect():
        short = item.where(F.col("n") == n).select("item", F.xxhash64("item_words").alias("hash"))
        runs = doc.select("doc", F.posexplode(once(words(F.col("text")), runs_of(n))).alias("shift", "hash"))
        met = met.unionByName(runs.join(short, "hash").select("doc", "item", "shift"))
    met = met.distinct().join(item.select("item", "item_id", "item_words"), "item")
    met = written(met.groupBy("doc").agg(F.collect_list(F.struct("item_id", "item_words", "shift")).alias("met")), "met")

    def windows(w: Column, m: Column) -> Column:
        """Starts of the windows of item ``m`` that the document's words ``w`` repeat at the item's place."""
        length = F.least(F.size(m.item_words), F.lit(WINDOW))
        same = lambda s: (s + m["shift"] >= 0) & (F.slice(w, F.greatest(s + m["shift"] + 1, F.lit(1)), length) == F.slice(m.item_words, s + 1, length))
        return F.filter(F.sequence(F.lit(0), F.size(m.item_words) - length), same)

    def hits(w: Column, met: Column) -> Column:
        found = F.transform(met, lambda m: F.struct(m.item_id.alias("item_id"), F.transform(windows(w, m), lambda s: F.sequence(s + m["shift"], s + m["shift"] + F.least(F.size(m.item_words), F.lit(WINDOW)) - 1)).alias("places")))
        found = F.filter(found, lambda x: F.size(x.places) > 0)
        return once(found, lambda f: F.struct(F.size(w).cast("long").alias("n_words"), F.size(F.array_distinct(F.flatten(F.flatten(f.places)))).cast("long").alias("n_hit"), F.array_sort(F.array_distinct(f.item_id)).alias("ids")))

    none = F.array().cast("array<struct<item_id:string,item_words:array<string>,shift:int>>")
    hashed = docs.withColumn("__doc", F.xxhash64(F.col(text)))
    # A merge join at every size: documents are shuffled once, and what they meet is never broadcast.
    found = hashed.join(met.select(F.col("doc").alias("__doc"), F.col("met").alias("__met")).hint("merge"), "__doc", "left")
    return found.select(*docs.columns, once(words(F.col(text)), lambda w: hits(w, F.coalesce("__met", none))).alias(MARK))


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """For each row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return marked(rows, items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))).select(
        "doc_id", f"{MARK}.n_words", f"{MARK}.n_hit", F.size(f"{MARK}.ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{MARK}.ids", ","), 256).alias("items_sha256"), (F.col(f"{MARK}.n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that share no window with an item, with all columns."""
    kept = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    place = kept.columns[docs.columns.index("text")]
    found = marked(kept.withColumnRenamed(place, "text"), items).withColumnRenamed("text", place).where(F.col(f"{MARK}.n_hit") == 0)
    return found.select(*[F.col(c).alias(name) for c, name in zip(kept.columns, docs.columns, strict=True)])


SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, w[s : s + least(len(w), {WINDOW}) - 1] AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, p, w[p : p + n - 1] AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lens WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, p, n FROM dw JOIN iw USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
