"""Language identification: known words first, shorter and shorter character n-grams for the others.

Training counts each word of each language over all training rows, and from these counts each n-gram of one to four
characters of the words (with word ends marked). Every word and n-gram is kept, in tables. A known word adds its log
frequency in each language. An unseen word adds the mean over its characters of the log frequency of the longest
known n-gram that ends there. The language with the largest sum wins, the first by name among equals; the score is its share among all
languages when the sums are read as log likelihoods.

The sums of a word are worked out once, whatever the number of texts that hold it. The most frequent words and n-grams, ``HEAD`` numbers at
most, are broadcast; the rest of a text's words are joined with the table of all words and added by row. What is in the
head changes the work and no sum. Words beyond it are rare by its definition, so no key of that join is hot (those over ``LONG``
characters, which are never in it, aside). More languages make the head shorter; their number has no limit.

A score near 1 only says that no other language is nearer, and comes with length for any text. So a model with spread (that of the pipeline) gives score 0 unless
the text is like its language: the mean over its words of the n-gram log frequency by character lies at most one standard deviation, and one and a half
standard errors, below the mean of the language's training words. This does not depend on length.

A text that is null or holds no letter is ``und`` with score 0. Rows with null language or null ``doc_id`` are not
trained on. With nothing to train on, all are ``und``. Repeated rows count as often as they occur. Words are runs of
letters in lower case; the whole text counts.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import largest, slices
from weftline.settings import written

FOLDS, HELD_OUT = 4, 2
HEAD = 1_000_000
"""Numbers (one a word or n-gram and language) that are broadcast."""
LONG = 64
LONGEST = 4
SMOOTHING = 0.5
LEARNED = 200
"""Distinct training words from which a language has a spread to judge by."""
TEXT, ROW = "__text", "__row"
_WORD = re.compile(r"[^\W\d_]+")
COUNTS = "array<struct<lang:int,n:bigint>>"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def distinct_words(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words with a letter of all texts, and for each occurrence which it is and the text it is in."""
    found, sizes = [], []
    for text in texts:
        each = words_of(text)
        found += each
        sizes.append(len(each))
    coded = pa.array(found, pa.string()).dictionary_encode()
    words, place, row = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(texts)), sizes)
    lettered = np.array([w.isalpha() or any(map(str.isalpha, w)) for w in words], bool)
    if not lettered.all():
        kept = lettered[place]
        place, row = (np.cumsum(lettered) - 1)[place[kept]], row[kept]
        words = [w for w, good in zip(words, lettered, strict=True) if good]
    return words, place, row


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str | None, Counter[str]] = defaultdict(Counter)

    def out() -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["lang", "item", "n"])
        counts.clear()

    for part in slices(batches, "text"):
        words, place, row = distinct_words(part.column("text").to_pylist())
        coded = part.column("lang").dictionary_encode()
        langs = [*coded.dictionary.to_pylist(), None]
        lang = coded.indices.fill_null(len(langs) - 1).to_numpy(zero_copy_only=False)
        each = np.bincount(place * len(langs) + lang[row], minlength=len(words) * len(langs)).reshape(len(words), len(langs))
        for i, name in enumerate(langs):
            c = counts[name]
            for k in np.flatnonzero(each[:, i]).tolist():
                c[words[k]] += int(each[k, i])
        if sum(map(len, counts.values())) > 300_000:
            yield from out()
    yield from out()


def grams_at(word: str) -> list[list[str]]:
    """For each character of the marked word, its n-grams that end there, longest first."""
    marked = f"<{word}>"
    return [[marked[max(0, i - n) : i] for n in range(min(LONGEST, i), 0, -1)] for i in range(2, len(marked) + 1)]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter[str]] = defaultdict(Counter)

    def out() -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["lang", "item", "n"])
        counts.clear()

    for batch in batches:
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "item", "n")), strict=True):
            c, marked = counts[lang], f"<{word}>"
            for size in range(1, LONGEST + 1):
                for i in range(max(2, size), len(marked) + 1):
                    c[marked[i - size : i]] += n
        if sum(map(len, counts.values())) > 300_000:
            yield from out()
    yield from out()


@dataclass
class Model:
    """The rule in memory: log frequencies, a row for each word or n-gram held, a column for each language."""

    langs: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    rows: np.ndarray
    """The last row is that of characters never seen."""

    def of(self, word: str) -> np.ndarray:
        if word in self.words:
            return self.rows[self.words[word]]
        none = len(self.rows) - 1
        return self.rows[[next((self.grams[g] for g in ends if g in self.grams), none) for ends in grams_at(word)]].mean(0)

    def sums(self, text: str | None) -> tuple[np.ndarray, int]:
        """Summed log frequencies by language, and the number of words with a letter."""
        found = [self.of(w) for w in words_of(text) if any(map(str.isalpha, w))]
        return np.sum(found, axis=0) if found else np.zeros(len(self.langs)), len(found)


@dataclass
class Learned:
    """Tables (item, counts) of all words and all n-grams, and the totals that make log frequencies of their counts."""

    langs: list[str]
    words: DataFrame
    grams: DataFrame
    under: np.ndarray
    """What counts are divided by, by length of n-gram (row 0: words) and language."""
    spread: dict[int, tuple[float, float]] = field(default_factory=dict)
    """Mean and standard deviation of the form over the training words of a language."""
    judged: bool = False
    head: int = HEAD

    def most(self) -> int:
        return self.head // max(1, len(self.langs))


def _logs(counts: pa.Array, under: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log frequencies of lists of (lang, n), the list's row of ``under`` by its size."""
    n = np.zeros((len(counts), under.shape[1]))
    flat, ends = counts.flatten(), np.diff(counts.offsets.to_numpy())
    n[np.repeat(np.arange(len(counts)), ends), flat.field("lang").to_numpy()] = flat.field("n").to_numpy()
    return np.log((n + SMOOTHING) / under[sizes])


def _floor(under: np.ndarray) -> float:
    """The log frequency of characters never seen: that of nothing in the largest total."""
    return float(np.log(SMOOTHING / under.max()))


def _backed(broadcast, under: np.ndarray, all_words: bool):
    """Words with their own log frequencies (``vec``; null when not known), the sum of those n-grams that the head decides (``form``),
    the number of characters, and what the head leaves open: lists of n-grams, longest first, with the number of characters that ask for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows = broadcast.value
        none = len(rows) - 1
        for part in slices(batches, "item", 1 << 17):
            counts = part.column("counts")
            seen = ~counts.is_null().to_numpy(zero_copy_only=False)
            vec: list = [None] * len(seen)
            own = _logs(counts.filter(pa.array(seen)), under, np.zeros(int(seen.sum()), int))
            for i, x in zip(np.flatnonzero(seen).tolist(), own.tolist(), strict=True):
                vec[i] = x
            at, sizes, chars, open_ = [], [], [], []
            for word, has in zip(part.column("item").to_pylist(), seen.tolist(), strict=True):
                asked: Counter[tuple[str, ...]] = Counter()
                ends = grams_at(word) if all_words or not has else []
                before = len(at)
                for grams in ends:
                    i = known.get(grams[0])
                    if i is None:
                        asked[tuple(grams)] += 1
                    else:
                        at.append(i)
                sizes.append(len(at) - before)
                chars.append(len(ends))
                open_.append([{"k": k, "grams": list(g)} for g, k in asked.items()])
            which = np.repeat(np.arange(len(sizes)), sizes)
            form = np.stack([np.bincount(which, rows[at, i], len(sizes)) for i in range(under.shape[1])], 1)
            yield pa.RecordBatch.from_arrays(
                [part.column("item"), part.column("n"), pa.array(vec, pa.list_(pa.float64())), pa.array(form.tolist(), pa.list_(pa.float64())), pa.array(chars, pa.int32()),
                 pa.array([hashlib.md5(w.encode("utf-8", "surrogatepass")).hexdigest() if o else None for w, o in zip(part.column("item").to_pylist(), open_, strict=True)], pa.string()),
                 pa.array(open_, pa.list_(pa.struct([("k", pa.int64()), ("grams", pa.list_(pa.string()))])))],
                ["item", "n", "vec", "form", "chars", "key", "open"],
            )

    return run


def _gram_logs(under: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Log frequencies of n-grams met (size over 0) or never seen (size 0), times the characters that ask for them."""
        for batch in batches:
            if batch.num_rows:
                size, k = batch.column("size").to_numpy(), batch.column("k").to_numpy()
                logs = np.where(size[:, None] > 0, _logs(batch.column("counts"), under, size), _floor(under))
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array((logs * k[:, None]).tolist(), pa.list_(pa.float64()))], ["key", "more"])

    return run


def _sum_each(column: str, langs: list[str], weight: Column | None = None) -> Column:
    """Lists of numbers by language, added up in each place."""
    one = F.lit(1) if weight is None else weight
    return F.array(*[F.sum(one * F.col(column)[i]) for i in range(len(langs))])


def sums_of(asked: DataFrame, model: Learned, forms: bool) -> DataFrame:
    """For each word of ``asked`` (item, n): what it adds in each language (``vec``) and, with ``forms``, its mean n-gram log frequency (``form``)."""
    spark = asked.sparkSession
    grams = largest(model.grams, model.most()).toArrow()
    rows = _logs(grams.column("counts").combine_chunks(), model.under, np.array([len(g) for g in grams.column("item").to_pylist()], int))
    head = spark.sparkContext.broadcast((dict(zip(grams.column("item").to_pylist(), range(grams.num_rows), strict=True)), np.vstack([rows, np.full((1, len(model.langs)), _floor(model.under))])))
    numbers = "array<double>"
    found = asked.join(model.words.select("item", "counts"), "item", "left").select("item", "n", "counts")
    found = written(found.mapInArrow(_backed(head, model.under, forms), f"item string, n long, vec {numbers}, form {numbers}, chars int, key string, open array<struct<k:bigint,grams:array<string>>>"), "backed")
    # Each open list takes the first of its n-grams that is known.
    open_ = found.where("size(open) > 0").select("key", F.inline("open"))
    lists = open_.groupBy("grams").agg(F.count("*").alias("asked")).select("grams", F.posexplode("grams").alias("turn", "item"))
    first = lists.join(model.grams.select("item", "counts"), "item", "left").groupBy("grams")
    first = first.agg(F.min_by(F.struct(F.length("item").alias("size"), "counts"), F.when(F.col("counts").isNotNull(), F.col("turn"))).alias("hit"))
    empty = F.array().cast(COUNTS)
    hits = open_.join(first, "grams").select("key", "k", F.coalesce("hit.size", F.lit(0)).alias("size"), F.coalesce("hit.counts", empty).alias("counts"))
    more = hits.mapInArrow(_gram_logs(model.under), f"key string, more {numbers}").groupBy("key").agg(_sum_each("more", model.langs).alias("more"))
    # Words that the head decides as a whole have no key and meet no join.
    whole = found.where("key is null").select("item", "n", "vec", "form", "chars", F.lit(None).cast(numbers).alias("more"))
    whole = whole.unionByName(found.where("key is not null").join(more, "key", "left").select(*whole.columns))
    mean = F.transform("form", lambda x, i: (x + F.coalesce(F.col("more")[i], F.lit(0.0))) / F.col("chars"))
    return whole.select("item", "n", F.coalesce("vec", mean).alias("vec"), (mean if forms else F.lit(None).cast(numbers)).alias("form"))


def _by_item(counts: DataFrame, langs: list[str]) -> DataFrame:
    """Counts (lang, item, n) as one row an item."""
    number = (F.array_position(F.lit(langs), F.col("lang")) - 1).cast("int")
    return counts.groupBy("item").agg(F.sum("n").alias("n"), F.collect_list(F.struct(number.alias("lang"), "n")).alias("counts"))


def counted_words(rows: DataFrame) -> DataFrame:
    """How often each word occurs in rows (lang, text) by language, those without one included: (lang, item, n), written."""
    counted = rows.select("lang", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_count_words, "lang string, item string, n long")
    return written(counted.groupBy("lang", "item").agg(F.sum("n").alias("n")), "words")


def train(rows: DataFrame, spread: bool = True, head: int = HEAD) -> Learned:
    """A model from rows (lang, text); without ``spread``, it finds every text alike."""
    return learned(counted_words(rows.where("lang is not null")), spread, head)


def learned(counts: DataFrame, spread: bool = True, head: int = HEAD) -> Learned:
    """A model from ``counted_words``; it does not learn from words without a language."""
    by_lang = counts.where("lang is not null")
    totals = dict(by_lang.groupBy("lang").agg(F.sum("n")).collect())
    langs = sorted(totals)
    words = written(_by_item(by_lang, langs or [""]), "word_counts")
    grams = by_lang.mapInArrow(_count_grams, "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n"))
    grams = written(grams, "gram_counts")
    under = np.zeros((LONGEST + 1, len(langs)))
    under[0] = [totals[x] for x in langs]
    for size, lang, n in grams.groupBy(F.length("item"), "lang").agg(F.sum("n")).collect():
        under[size, langs.index(lang)] = n
    grams = written(_by_item(grams, langs or [""]), "grams")
    distinct = {0: words.count()} | dict(grams.groupBy(F.length("item")).agg(F.count("*")).collect())
    under += SMOOTHING * (1 + np.array([distinct.get(size, 0) for size in range(LONGEST + 1)]))[:, None]
    model = Learned(langs, words, grams, under, judged=spread, head=head)
    if spread and langs:
        form = F.col("form")[(F.array_position(F.lit(langs), F.col("lang")) - 1).cast("int")]
        found = by_lang.join(sums_of(words.select("item", "n"), model, True).select("item", "form"), "item").select("lang", "n", form.alias("x"))
        found = found.groupBy("lang").agg(F.count("*"), F.sum("n"), F.sum(F.col("n") * F.col("x")), F.sum(F.col("n") * F.col("x") * F.col("x")))
        for lang, k, n, x, xx in found.collect():
            if k >= LEARNED:
                model.spread[langs.index(lang)] = x / n, max(0.0, xx / n - (x / n) ** 2) ** 0.5
    return model


def _add(broadcast, keep: list[str], n_langs: int, forms: bool):
    """Sums of the head's words for each row, the number of its words, and the words that are not in the head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows = broadcast.value
        for part in slices(batches, TEXT):
            words, place, row = distinct_words(part.column(TEXT).to_pylist())
            at = np.array([known.get(w, -1) for w in words], np.int64)[place]
            head, size = at >= 0, part.num_rows
            sums = np.stack([np.bincount(row[head], rows[at[head], i], size) for i in range(rows.shape[1])], 1)
            pair, n = np.unique(row[~head] * len(words) + place[~head], return_counts=True)
            ends = np.searchsorted(pair, np.arange(size + 1) * len(words)).astype(np.int32)
            rest = pa.StructArray.from_arrays([pa.array([words[i] for i in (pair % max(1, len(words))).tolist()], pa.string()), pa.array(n, pa.int64())], ["item", "k"])
            numbers = lambda x: pa.array(x.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in keep), part.column(ROW), pa.array(np.bincount(row, minlength=size).astype(np.int64)), numbers(sums[:, :n_langs]), numbers(sums[:, n_langs:]) if forms else pa.nulls(size, pa.list_(pa.float64())),
                 pa.ListArray.from_arrays(pa.array(ends), rest)],
                [*keep, ROW, "__count", "__vec", "__form", "__rest"],
            )

    return run


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT


def model_of(docs: DataFrame, spread: bool = True, head: int = HEAD) -> Learned:
    """The model of the training rows of ``docs`` (doc_id, text, lang)."""
    return train(docs.where(~held_out()).select("lang", "text"), spread, head)


def predicted(docs: DataFrame, model: Learned, counts: DataFrame | None = None) -> DataFrame:
    """``docs`` without its text, with lang_pred and score. Its columns may have any name but those of this module that begin with two underscores.

    ``counts`` are the ``counted_words`` of all texts of ``docs``, where they are known already."""
    spark, langs = docs.sparkSession, model.langs
    kept = docs.drop("text", "lang_pred", "score")
    if not langs:
        return kept.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    text = F.coalesce("text", F.lit("")).alias(TEXT)
    if counts is None:
        counts = docs.select(F.lit(None).cast("string").alias("lang"), text.alias("text")).mapInArrow(_count_words, "lang string, item string, n long")
    vectors = written(sums_of(counts.groupBy("item").agg(F.sum("n").alias("n")), model, model.judged), "vectors")
    top = largest(vectors.where(F.length("item") <= LONG), model.most()).toArrow()
    rows = np.array([a + (b or []) for a, b in zip(top.column("vec").to_pylist(), top.column("form").to_pylist(), strict=True)], float)
    width = len(langs) * (2 if model.judged else 1)
    head = spark.sparkContext.broadcast((dict(zip(top.column("item").to_pylist(), range(top.num_rows), strict=True)), rows.reshape(top.num_rows, width)))

    # Row numbers hold once they are written.
    each = docs.select(*kept.columns, text, F.monotonically_increasing_id().alias(ROW))
    numbers = "array<double>"
    added = T._parse_datatype_string(f"{ROW} long, __count long, __vec {numbers}, __form {numbers}, __rest array<struct<item:string,k:bigint>>")
    found = written(each.mapInArrow(_add(head, kept.columns, len(langs), model.judged), T.StructType([*kept.schema.fields, *added.fields])), "sums")
    rest = found.select(ROW, F.inline("__rest")).join(vectors.select("item", "vec", "form"), "item")
    rest = rest.groupBy(ROW).agg(_sum_each("vec", langs, F.col("k")).alias("__vec2"), _sum_each("form", langs, F.col("k")).alias("__form2"))
    both = found.drop("__rest").join(rest, ROW, "left")
    total = lambda a: F.transform(a, lambda x, i: x + F.coalesce(F.col(f"{a}2")[i], F.lit(0.0)))
    both = both.withColumn("__vec", total("__vec"))
    best = F.array_max("__vec")
    both = both.withColumn("__best", F.array_position("__vec", best).cast("int"))
    share = 1 / F.aggregate("__vec", F.lit(0.0), lambda a, x: a + F.exp(x - best))
    if model.judged:
        spread = lambda i: F.get(F.lit([float(model.spread[x][i]) if x in model.spread else float("nan") for x in range(len(langs))]), F.col("__best") - 1)
        mean = F.get(total("__form"), F.col("__best") - 1) / F.col("__count")
        alike = F.isnan(spread(0)) | (mean >= spread(0) - spread(1) * (1 + 1.5 / F.sqrt("__count")))
        share = F.when(alike, share).otherwise(0.0)
    worded = F.col("__count") > 0
    return both.select(*kept.columns, F.when(worded, F.get(F.lit(langs), F.col("__best") - 1)).otherwise("und").alias("lang_pred"), F.when(worded, share).otherwise(0.0).alias("score"))


def languages(docs: DataFrame) -> DataFrame:
    """For each row of ``docs``: doc_id, held_out, lang_pred, score.

    Texts are cut into words for the counts once: those that are not trained on count without a language."""
    counts = counted_words(docs.select(F.when(~held_out(), F.col("lang")).alias("lang"), "text"))
    model = learned(counts, spread=False)
    return predicted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text"), model, counts)


def accepted(docs: DataFrame, model: Learned, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text is in a known language with a score of at least ``least``, with all columns."""
    kept = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = F.col(kept.columns[docs.columns.index("text")])
    found = predicted(kept.withColumn("text", text), model).where(F.col("score") >= least)
    return found.select(*[F.col(c).alias(name) for c, name in zip(kept.columns, docs.columns, strict=True)])
