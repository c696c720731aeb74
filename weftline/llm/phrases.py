"""Phrases whose words stand together more often than their parts would, by language, from weighted acyclic automata.

Phrases are counted length by length. A batch of texts gives its n-grams in order, with their counts; they become transducers,
one for each range of prefixes (of hashes of the first two words, so that no first word has a range of its own): deterministic acyclic automata over words whose paths' weights
are the counts, built state by state as the sorted n-grams come, equal states being one. The transducers of a range meet in one place, where
their weights are added up, and those of ``least`` and more become the range's own transducer. Only n-grams whose two parts of
n - 1 words are frequent are counted: a bitmap of ``SLOTS`` hashed slots says so. A slot that two n-grams share costs work, it changes no count.

For the parts of phrases, the wanted parts of a range become an automaton too, and the composition of both (one walk over the paths
they share) gives the parts' counts. A phrase is dropped where a longer one by a word holds it and is as frequent; longer ones still
need no look, since what lies between is as frequent as both.

Lower case is that of A-Z. Words are what lies between spaces and tabs, pieces what lies between line ends (U+000A to U+000D) and ``.,;:!?``. Counts, scores and sizes are exact;
a score's terms have up to 38 digits. A null or empty text has no word, a null language is ``und``. A language without candidates gives
no row, and so does an empty table. Ties go by count, then by the phrase's UTF-8 bytes. Repeated rows count as often as
they occur. A very long text is one batch. No language, word or phrase takes more than its share of one task: what a batch sends is
counted already, and the list of a language is cut in two steps.
"""

from __future__ import annotations

import marshal
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import STEP, mixed, slices, words
from weftline.settings import written

LEAST = 100
LONGEST = 5
TOP = 2000
SLOTS = 1 << 26
"""Bits of the map of frequent n-grams; it is broadcast, 8 MB whatever the input."""
BATCH = 8 << 20
RANGE = 1 << 22
"""Words of the corpus for each range of prefixes."""
APART, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
_LOWER = bytes(range(256)).lower()
_SPREAD = 64


# --- transducers -----------------------------------------------------------------------------------------------


class Transducer:
    """Sequences of words with weights. A path's weight is the sum of its arcs' and its last state's.

    ``add`` takes sequences in order; a state is closed when the next sequence has left it: its least weight moves to the arc that
    leads to it, and a state that equals a closed one is that one."""

    def __init__(self):
        self.states: list[tuple] = [_LEAF]  # weight at the end or None, and arcs: word, weight, state
        self.known: dict[tuple, int] = {_LEAF: 0}
        self.last: tuple = ()
        self.path: list[list] = [[None, []]]  # the states on the way to the last sequence's own, which the last arc leads to
        self.root = (0, None)

    def add(self, sequence: tuple, weight: int) -> None:
        if not sequence:
            self.path[0][0] = weight
            return
        same = 0
        for a, b in zip(sequence, self.last, strict=False):
            if a != b:
                break
            same += 1
        path = self.path
        if same == len(self.last) and same:  # goes on where the last one ends
            arcs = path[-1][1]
            path.append([arcs[-1][1], []])
            arcs[-1] = arcs[-1][0]
        elif same < len(path) - 1:
            self._close(same)
        for word in sequence[same:-1]:
            path[-1][1].append(word)
            path.append([None, []])
        path[-1][1].append((sequence[-1], weight, 0))
        self.last = sequence

    def add_all(self, prefix: tuple, words: list, weights: list) -> None:
        """As ``add`` of each word, in order, behind one prefix."""
        self.add((*prefix, words[0]), weights[0])
        if len(words) > 1:
            self.path[-1][1].extend(zip(words[1:], weights[1:], repeat(0)))
            self.last = (*prefix, words[-1])

    def _close(self, depth: int) -> None:
        while len(self.path) > depth + 1:
            state = self._closed(self.path.pop())
            arcs = self.path[-1][1]
            arcs[-1] = (arcs[-1], *state)

    def _closed(self, state: list) -> tuple[int, int]:
        final, arcs = state
        least = min([a[1] for a in arcs], default=final)
        least = min(least, final) if final is not None else least
        if least:
            arcs = [(w, x - least, s) for w, x, s in arcs]
            final = None if final is None else final - least
        key = (final, tuple(arcs))
        number = self.known.get(key)
        if number is None:
            number = self.known[key] = len(self.states)
            self.states.append(key)
        return least, number

    def finish(self) -> Transducer:
        if self.last or self.path[0][0] is not None:
            self._close(0)
            self.root = self._closed(self.path[0])
        self.path, self.known, self.last = [[None, []]], {}, ()
        return self

    def paths(self) -> Iterator[tuple[tuple, int]]:
        """Sequences in order, with their weights."""
        if self.root[1] is None:
            return
        stack = [((), *self.root)]
        while stack:
            sequence, weight, number = stack.pop()
            final, arcs = self.states[number]
            if final is not None:
                yield sequence, weight + final
            if all(s == 0 for _, _, s in arcs):
                for w, x, _ in arcs:
                    yield (*sequence, w), weight + x
            else:
                stack += [((*sequence, w), weight + x, s) for w, x, s in reversed(arcs)]

    def composed(self, other: Transducer) -> Iterator[tuple[tuple, int, int]]:
        """The sequences that both hold, in order, with both weights: only what both share is walked."""
        if self.root[1] is None or other.root[1] is None:
            return
        stack = [((), *self.root, *other.root)]
        while stack:
            sequence, a, i, b, j = stack.pop()
            (final_a, arcs_a), (final_b, arcs_b) = self.states[i], other.states[j]
            if final_a is not None and final_b is not None:
                yield sequence, a + final_a, b + final_b
            there = {w: (x, s) for w, x, s in arcs_a}
            for w, y, t in reversed(arcs_b):
                if w in there:
                    x, s = there[w]
                    stack.append(((*sequence, w), a + x, s, b + y, t))

    def dumped(self) -> bytes:
        """For the exchange between workers of one job, which run one version of Python."""
        return zlib.compress(marshal.dumps((self.root, self.states)), 1)

    @classmethod
    def loaded(cls, raw: bytes) -> Transducer:
        out = cls()
        out.root, out.states = marshal.loads(zlib.decompress(raw))
        return out


_LEAF = (0, ())
"""The state after which nothing comes; number 0 of every transducer."""


def transducer(sequences) -> Transducer:
    """Of (sequence, weight) in order, no sequence twice."""
    out = Transducer()
    for sequence, weight in sequences:
        out.add(sequence, weight)
    return out.finish()


def united(automata) -> dict[tuple, int]:
    """The sequences of several transducers with the sums of their weights."""
    sums: dict[tuple, int] = {}
    for raw in automata:
        for sequence, weight in Transducer.loaded(raw).paths():
            sums[sequence] = sums.get(sequence, 0) + weight
    return sums


# --- hashes ----------------------------------------------------------------------------------------------------


def _word_hashes(lang: str, distinct: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode()) & 0xFFFFFFFF
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in distinct], np.uint64)


def _gram_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """Hashes of n-grams from those of their words."""
    out = mixed(parts[0].copy())
    for p in parts[1:]:
        out = mixed(out * STEP + p)
    return out


def _hash_of(lang: str, sequence) -> int:
    with np.errstate(over="ignore"):
        return int(_gram_hashes([x[None] for x in _word_hashes(lang, [w.encode("utf-8", "surrogatepass") for w in sequence])])[0])


def _ranges(parts: list[np.ndarray], ranges: int) -> np.ndarray:
    """The range of prefixes of n-grams, from the hashes of their first words, two at most. What follows a word lies in a quarter of the ranges."""
    first = mixed(parts[0].copy())
    if len(parts) > 1:
        first = mixed(first + parts[1] % np.uint64(-(-ranges // 4)))
    return (first % np.uint64(ranges)).astype(np.int64)


def _range_of_words(lang: str, sequence, ranges: int) -> int:
    with np.errstate(over="ignore"):
        return int(_ranges([x[None] for x in _word_hashes(lang, [w.encode("utf-8", "surrogatepass") for w in sequence[:2]])], ranges)[0])


def slot(hashes):
    return hashes % SLOTS


def bitmap(rows: DataFrame) -> np.ndarray:
    """A bit for each slot in ``rows``: SLOTS / 8 bytes at most come to the driver."""
    one = F.col("slot") + 1
    parts = rows.groupBy(F.bitmap_bucket_number(one).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("bits")).collect()
    out = np.zeros(SLOTS // 8, np.uint8)
    for r in parts:
        out[(r.bucket - 1) * 4096 : r.bucket * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def _set(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    slots = slots.astype(np.int64)
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


# --- batches of texts ------------------------------------------------------------------------------------------


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    for batch in slices(batches, "text", BATCH):
        langs = batch.column("lang").dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch.column("text").filter(pc.equal(langs.indices, k))
            ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
            data = (texts.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[ends[0] : ends[-1]].translate(_LOWER)
            yield lang, pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(data)])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, texts in _by_language(batches):
        found = words(texts, APART, BREAKS)[0].dictionary_encode()
        n = np.bincount(found.indices.to_numpy(zero_copy_only=False), minlength=len(found.dictionary))
        out = pa.concat_arrays([found.dictionary.cast(pa.string()), pa.array([None], pa.string())])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(out)), out, pa.array(np.append(n, n.sum()).astype(np.int64))], ["lang", "word", "n"])


def _frequent_grams(lang: str, texts: pa.Array, n: int, bits: np.ndarray):
    """Words of the texts as numbers in their order, where n-grams with frequent parts begin, and the pieces of words."""
    found, _, piece = words(texts, APART, BREAKS)
    found = found.dictionary_encode()
    order = pc.array_sort_indices(found.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    distinct = found.dictionary.take(pa.array(order)).to_pylist()
    ids = rank[found.indices.to_numpy(zero_copy_only=False)]
    hashes = _word_hashes(lang, distinct)
    if n == 2:
        good = _set(bits, slot(_gram_hashes([hashes])))[ids]
    else:
        m = n - 1
        ends = len(ids) - m + 1
        if ends <= 0:
            return distinct, ids, np.zeros(0, np.int64), piece, hashes
        whole = np.flatnonzero(piece[:ends] == piece[m - 1 :])
        good = np.zeros(len(ids), bool)
        good[whole] = _set(bits, slot(_gram_hashes([hashes[ids[whole + k]] for k in range(m)])))
    both = np.flatnonzero(good[:-1] & good[1:])
    both = both[both + n <= len(ids)]
    return distinct, ids, both[piece[both] == piece[both + n - 1]], piece, hashes


def _grams(n: int, bits, ranges: int, runs: bool):
    """Transducers of a batch's n-grams by range, and, if wanted, the runs of more than n words all of whose n-grams may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for lang, texts in _by_language(batches):
                distinct, ids, starts, piece, hashes = _frequent_grams(lang, texts, n, bits.value)
                if not len(starts):
                    continue
                names = [w.decode() for w in distinct]
                table = np.stack([ids[starts + k] for k in range(n)])
                place = _ranges([hashes[table[0]], hashes[table[1]]], ranges)
                order = np.lexsort((*table[::-1], place))
                table, place = table[:, order], place[order]
                ranged = np.concatenate(([True], place[1:] != place[:-1]))
                fresh = ranged | np.concatenate(([True], (table[:-1, 1:] != table[:-1, :-1]).any(0)))  # another prefix of n - 1 words
                first = np.flatnonzero(fresh | np.concatenate(([True], table[-1, 1:] != table[-1, :-1])))
                count = np.diff(np.append(first, len(order))).tolist()
                table, place, ranged = table[:, first], place[first], np.append(np.flatnonzero(ranged[first]), len(first)).tolist()
                groups = np.append(np.flatnonzero(fresh[first]), len(first))
                heads = list(zip(*([names[i] for i in table[k][groups[:-1]].tolist()] for k in range(n - 1)), strict=True))
                tails, groups = [names[i] for i in table[-1].tolist()], groups.tolist()
                out_place, out_text, out_raw, g = [], [], [], 0
                for a, b in zip(ranged[:-1], ranged[1:], strict=True):
                    own = Transducer()
                    while groups[g] < b:
                        own.add_all((lang, *heads[g]), tails[groups[g] : groups[g + 1]], count[groups[g] : groups[g + 1]])
                        g += 1
                    out_raw.append(own.finish().dumped())
                    out_place.append(int(place[a]))
                    out_text.append(None)
                if runs:
                    cut = np.flatnonzero(np.diff(starts) != 1) + 1
                    for a, b in zip(np.append(0, cut).tolist(), np.append(cut, len(starts)).tolist(), strict=True):
                        if b - a > 1:  # neighbouring starts are of one piece, or the first would reach over its end
                            out_text.append(" ".join(names[i] for i in ids[starts[a] : starts[b - 1] + n].tolist()))
                            out_raw.append(None)
                            out_place.append(None)
                for a in range(0, len(out_place), 4096):
                    part = slice(a, a + 4096)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(out_place[part])), pa.array(out_text[part], pa.string()), pa.array(out_place[part], pa.int64()), pa.array(out_raw[part], pa.binary())], ["lang", "text", "range", "automaton"])

    return run


# --- ranges ----------------------------------------------------------------------------------------------------


def _union(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Transducers in order of their ranges, as one a range of the frequent sequences."""
        now, sums = None, {}

        def out() -> pa.RecordBatch:
            kept = transducer(sorted(((k, w) for k, w in sums.items() if w >= least), key=lambda x: [y.encode() for y in x[0]]))
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([kept.dumped()], pa.binary())], ["range", "automaton"])

        for batch in batches:
            for place, raw in zip(batch.column("range").to_pylist(), batch.column("automaton"), strict=True):
                if place != now:
                    if sums:
                        yield out()
                    now, sums = place, {}
                for key, weight in united([raw.as_py()]).items():
                    sums[key] = sums.get(key, 0) + weight
        if sums:
            yield out()

    return run


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for place, raw in zip(batch.column("range").to_pylist(), batch.column("automaton"), strict=True):
            rows = [(key[0], key[1:], weight) for key, weight in Transducer.loaded(raw.as_py()).paths()]
            with np.errstate(over="ignore"):
                slots = [slot(_hash_of(lang, key)) for lang, key, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([place] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.string()), pa.array([list(r[1]) for r in rows], pa.list_(pa.string())), pa.array([r[2] for r in rows], pa.int64()), pa.array(slots, pa.int64())],
                ["range", "lang", "words", "n", "slot"],
            )


def _placed(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Frequent words, with their slots and ranges."""
        for batch in batches:
            rows = list(zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist(), strict=True))
            with np.errstate(over="ignore"):
                hashes = [_hash_of(lang, [w]) for lang, w in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_range_of_words(lang, [w], ranges) for lang, w in rows], pa.int64()), batch.column("lang"), pa.array([[w] for _, w in rows], pa.list_(pa.string())), batch.column("n"), pa.array([slot(h) for h in hashes], pa.int64())], ["range", "lang", "words", "n", "slot"]
            )

    return run


_COUNTED = "range long, lang string, words array<string>, n long, slot long"


def counted(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """All words and phrases that occur ``least`` times or more, by length: (range, lang, words, n, slot); and (lang, n) of all words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    frequent = texts.mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    frequent = written(frequent.where((F.col("n") >= least) | F.col("word").isNull()), "words")
    totals = frequent.where("word is null").select("lang", "n")
    ranges = max(1, (totals.agg(F.sum("n")).first()[0] or 0) // RANGE)
    levels = [written(frequent.where(f"word is not null and n >= {least}").mapInArrow(_placed(ranges), _COUNTED), "level")]
    for n in range(2, longest + 1):
        bits = spark.sparkContext.broadcast(bitmap(levels[-1]))
        runs = 3 <= n < longest
        shards = texts.mapInArrow(_grams(n, bits, ranges, runs), "lang string, text string, range long, automaton binary")
        shards = written(shards, "shards") if runs else shards
        merged = shards.where("range is not null").select("range", "automaton").repartition("range").sortWithinPartitions("range")
        merged = written(merged.mapInArrow(_union(least), "range long, automaton binary"), "union")
        levels.append(written(merged.mapInArrow(_told, _COUNTED), "level"))
        if runs:
            texts = shards.where("text is not null").select("lang", "text")
        bits.unpersist()
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out, totals


# --- parts and scores ------------------------------------------------------------------------------------------


def _looked_up(key: tuple, have: pa.Table, want: pa.Table) -> pa.Table:
    """Counts of the wanted parts of a range: its counts and the parts as transducers, composed."""

    def automaton(rows: pa.Table, weights: list[int]) -> Transducer:
        keys = [(lang, *ws) for lang, ws in zip(rows["lang"].to_pylist(), rows["words"].to_pylist(), strict=True)]
        return transducer(sorted(zip(keys, weights, strict=True), key=lambda x: [y.encode() for y in x[0]]))

    counts = automaton(have, have["n"].to_pylist())
    rows = list(counts.composed(automaton(want, [1] * want.num_rows)))
    return pa.Table.from_arrays([pa.array([k[0] for k, _, _ in rows], pa.string()), pa.array([list(k[1:]) for k, _, _ in rows], pa.list_(pa.string())), pa.array([w for _, w, _ in rows], pa.int64())], ["lang", "words", "n"])


def _range_of(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [_range_of_words(lang, ws, ranges) for lang, ws in zip(batch.column("lang").to_pylist(), batch.column("words").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), batch.column("lang"), batch.column("words")], ["range", "lang", "words"])

    return run


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts, totals = counted(docs, least, longest)
    counts = written(counts, "counts")
    ranges = max(1, (totals.agg(F.sum("n")).first()[0] or 0) // RANGE)
    size = F.size("words")
    phrases = counts.where(size > 1).select("lang", "words", "n")
    # A phrase and the longer ones by a word that hold it.
    none = F.lit(None).cast("long")
    inner = F.explode(F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1)))
    inside = phrases.where(size > 2).select("lang", inner.alias("words"), none.alias("a"), F.col("n").alias("longer"))
    kept = phrases.select("lang", "words", F.col("n").alias("a"), none.alias("longer")).unionByName(inside)
    kept = kept.groupBy("lang", "words").agg(F.max("a").alias("a"), F.max("longer").alias("longer"))
    kept = written(kept.where("longer is null or longer < a").select("lang", "words", "a"), "kept")
    cuts = kept.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = written(cuts.select("*", F.slice("words", F.lit(1), F.col("k")).alias("first"), F.slice("words", F.col("k") + 1, size - F.col("k")).alias("rest")), "cuts")
    want = cuts.select("lang", F.explode(F.array("first", "rest")).alias("words")).distinct().mapInArrow(_range_of(ranges), "range long, lang string, words array<string>")
    parts = counts.select("range", "lang", "words", "n").groupBy("range").cogroup(want.groupBy("range")).applyInArrow(_looked_up, "lang string, words array<string>, n long")
    parts = written(parts, "parts")
    left, right = (parts.select("lang", F.col("words").alias(side), F.col("n").alias(name)) for side, name in (("first", "l"), ("rest", "r")))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    exact = lambda name, digits: F.col(name).cast(f"decimal({digits},0)")
    scored = scored.withColumn("__up", F.lit(1000).cast("decimal(4,0)") * exact("a", 14) * exact("n", 18)).withColumn("__down", exact("l", 18) * exact("r", 18))
    scored = scored.withColumn("score", F.expr("__up div __down"))
    best = scored.groupBy("lang", "words").agg(F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "k")).alias("x"))
    rows = best.select("lang", F.array_join("words", " ").alias("phrase"), "x.a", "x.l", "x.r", "x.n", "x.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shard = F.pmod(F.xxhash64("phrase"), F.lit(_SPREAD))
    rows = rows.withColumn("__rank", F.row_number().over(Window.partitionBy("lang", shard).orderBy(*order))).where(F.col("__rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, row_number() OVER () AS p, ws FROM (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS ws
  FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\n\\x0b\\x0c\\r]')) AS piece FROM d)) WHERE len(ws) > 0),
g AS (SELECT lang, k, list_aggregate(ws[i:i + k - 1], 'string_agg', ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM p, (SELECT unnest(range(1, {LONGEST} + 1)) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a, string_split(phrase, ' ') AS ws FROM g GROUP BY ALL HAVING count(*) >= {LEAST}),
t AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM p GROUP BY lang),
longer AS (SELECT DISTINCT lang, list_aggregate(ws[i:i + m - 1], 'string_agg', ' ') AS phrase, a
  FROM (SELECT lang, ws, a, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM f WHERE k > 2))),
c AS (SELECT f.* FROM f WHERE k > 1 AND NOT EXISTS (SELECT 1 FROM longer x WHERE x.lang = f.lang AND x.phrase = f.phrase AND 100 * x.a >= 100 * f.a)),
cuts AS (SELECT lang, k, phrase, a, j, list_aggregate(ws[1:j], 'string_agg', ' ') AS first, list_aggregate(ws[j + 1:], 'string_agg', ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
s AS (SELECT cuts.lang, cuts.phrase, cuts.a, x.a AS l, y.a AS r, t.n, j, CAST((CAST(1000 AS HUGEINT) * cuts.a * t.n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.first JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.rest JOIN t ON t.lang = cuts.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM b) WHERE rank <= {TOP}
"""
