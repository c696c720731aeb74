"""Quality classifier from weak labels.

Heuristic labellers each call a text good or bad, or abstain. Their votes are counted by pattern over all documents
(3 to the power of the labellers at most), and expectation-maximisation over these counts estimates the share of good
documents and each labeller's rates of votes in either class. The posterior of a pattern is the label of its documents.
A linear scorer over hashed words and hashed word shapes learns these labels from a bounded sample (``SAMPLE`` documents of
either side at most, dealt by a hash) and scores all documents; so a text is judged by all its words, and not only by
what the labellers see.

Abuse is judged beside form, by a label model of its own: three labellers look at the words of ``ABUSE``, a lexicon by
language, as a share of the words, by the lines that hold them and by how many different ones occur. ``kept`` is about form
alone; ``toxic`` says whether the posterior of abuse is 0.5 or more, and ``accepted(..., toxic=False)`` drops these rows too.

Each row gives one row. A null text, or one without words, has score 0 and is not kept; it casts no vote and is
no example; its toxic score is 0. Without a document to learn from, every text with words has score 0.5 and is kept. Repeated rows count as often as they
occur; a null ``doc_id`` makes no difference.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import slices

SAMPLE = 2_000
FEATURES = 1 << 18
ROUNDS = 50
EPOCHS = 12
KEEP = 0.5
TOXIC = 0.5
TEXT = "__text"
GOOD, BAD, NONE = 2, 1, 0
_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()\-]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MARK = re.compile(r"[^\w\s]{2,}")
_END = re.compile(r"[.!?…]\s*$", re.M)


_LETTERS = re.compile(r"[^\W\d_]+")

ABUSE = {
    "en": "idiot idiots idiotic moron morons moronic imbecile stupid dumb pathetic worthless disgusting trash garbage scum loser losers scumbag bastard bastards bitch asshole fuck fucking fucked shit shitty bullshit cunt whore slut retard retarded jerk dumbass clown filthy vermin hate despise",
    "de": "idiot idioten idiotisch trottel vollidiot depp dumm dumme dummkopf blöd blöde blödmann arschloch scheiße scheiß wichser hurensohn schlampe fotze missgeburt abschaum dreckig widerlich wertlos erbärmlich",
    "fr": "idiot idiote idiots imbécile crétin crétins stupide débile connard connards connasse salaud salope pute putain merde enculé ordure ordures abruti dégoûtant pathétique",
    "es": "idiota idiotas imbécil estúpido estúpida tonto gilipollas cabrón cabrones puta puto mierda hijoputa pendejo asqueroso asquerosa patético patética maldito escoria",
}
"""Abusive words by language. A text is judged by all of them, as abuse crosses languages; words that mean no harm in another of the languages are left out."""
_ABUSIVE = frozenset(w for words in ABUSE.values() for w in words.split())

# --- labellers -------------------------------------------------------------------------------------------------


def _between(x: float, good: float, bad: float) -> int:
    """Good at ``good`` or beyond, bad at ``bad`` or beyond, on either side of what lies between."""
    if good < bad:
        return GOOD if x <= good else BAD if x >= bad else NONE
    return GOOD if x >= good else BAD if x <= bad else NONE


def votes(text: str, words: list[str]) -> tuple[int, ...]:
    """One vote of each labeller on a text with words."""
    n, chars = len(words), len(text)
    lines = [x for x in text.split("\n") if x.strip()]
    lengths = [len(w) for w in words]
    return (
        _between(len(_SYMBOL.findall(text)) / chars, 0.01, 0.04),
        _between(len(_UPPER.findall(text)) / chars, 0.08, 0.25),
        _between(len(_MARK.findall(text)) / n, 0.02, 0.15),
        _between(sum(not any(map(str.isalnum, w)) for w in words) / n, 0.02, 0.2),
        _between(sum(len(w) <= 3 and w.isalpha() for w in words) / n, 0.15, 0.03) if n >= 20 else NONE,
        _between(sum(lengths) / n, 9.5, 14),
        _between(1 - len(set(lines)) / len(lines), 0.1, 0.4),
        _between(len(_END.findall(text)) / len(lines), 0.5, 0.1),
        _between(sum(map(str.__eq__, words, words[1:])) / n, 0.05, 0.3),
        _between(len(set(words)) / n, 0.25, 0.1) if n >= 20 else NONE,
    )


def pattern(text: str, words: list[str]) -> int:
    out = 0
    for v in votes(text, words):
        out = out * 3 + v
    return out


LABELLERS = 10
ABUSE_LABELLERS = 3
ABUSE_PATTERNS = 3**ABUSE_LABELLERS


def abuse_pattern(text: str) -> int:
    """The votes of the labellers of abuse: share of abusive words, share of lines that hold one, different ones."""
    text = text.lower()
    words = _LETTERS.findall(text)
    if not words:
        return 0
    if _ABUSIVE.isdisjoint(words):
        return ABUSE_PATTERNS - 1
    lines = [x for line in text.split("\n") if (x := _LETTERS.findall(line))]
    hits = [w for w in words if w in _ABUSIVE]
    hit_lines = sum(not _ABUSIVE.isdisjoint(x) for x in lines)
    out = 0
    for v in (_between(len(hits) / len(words), 0, 0.005), _between(hit_lines / len(lines), 0, 0.2), _between(len(set(hits)), 0, 2)):
        out = out * 3 + v
    return out


def posteriors(counts: dict[int, int], labellers: int = LABELLERS) -> dict[int, float]:
    """Posterior of good for each pattern of votes, by expectation-maximisation over the counts of patterns."""
    if not counts:
        return {}
    keys = np.array(sorted(counts))
    n = np.array([counts[k] for k in keys.tolist()], float)
    cast = np.array([[k // 3 ** (labellers - 1 - i) % 3 for i in range(labellers)] for k in keys.tolist()])
    # It begins with the vote of the majority.
    good = 0.5 + 0.45 * np.sign((cast == GOOD).sum(1) - 2 * (cast == BAD).sum(1))
    for _ in range(ROUNDS):
        logs = []
        for q in (good, 1 - good):
            weight = n * q
            # An abstention says nothing: rates and likelihoods are those of the votes cast.
            rate = np.array([[weight[cast[:, i] == v].sum() + 0.5 for v in (BAD, GOOD)] for i in range(labellers)])
            log_rate = np.column_stack((np.zeros(labellers), np.log(rate / rate.sum(1, keepdims=True))))
            logs.append(np.log(weight.sum() + 1) + log_rate[np.arange(labellers), cast].sum(1))
        good = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -500, 500)))
    return dict(zip(keys.tolist(), good.tolist(), strict=True))


# --- linear scorer ---------------------------------------------------------------------------------------------

_SHAPES = [(re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"\d+"), "0"), (re.compile(r"[^\W\d_A-Z]+"), "a")]


def features(word: str) -> tuple[int, int]:
    """Hashed places of a word in lower case and of its shape (runs of a kind of character as one)."""
    shape = word
    for kind, mark in _SHAPES:
        shape = kind.sub(mark, shape)
    return xxhash.xxh32_intdigest("w" + word.lower()) % FEATURES, xxhash.xxh32_intdigest("s" + shape) % FEATURES


def fit(rows: list[tuple[np.ndarray, np.ndarray, float]]) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer from (places, shares, label), by stochastic gradients with adaptive steps."""
    weights, bias = np.zeros(FEATURES), 0.0
    squares, bias_squares = np.full(FEATURES, 1e-6), 1e-6
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)).tolist():
            at, share, label = rows[i]
            error = 1 / (1 + np.exp(-np.clip(weights[at] @ share + bias, -50, 50))) - label
            step = error * share + 1e-6 * weights[at]
            squares[at] += step * step
            weights[at] -= 0.5 * step / np.sqrt(squares[at])
            bias_squares += error * error
            bias -= 0.5 * error / np.sqrt(bias_squares)
    return weights, bias


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        found = [pattern(t, w) * ABUSE_PATTERNS + abuse_pattern(t) for t in part.column("text").to_pylist() if (w := t.split())]
        keys, n = np.unique(np.array(found, np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pattern", "n"])


def _examples(posterior: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            label, place, share, deal = [], [], [], []
            for text, h in zip(part.column("text").to_pylist(), part.column("deal").to_pylist(), strict=True):
                words = text.split()
                if words:
                    at, n = np.unique(np.array([features(w) for w in words]).ravel(), return_counts=True)
                    label.append(posterior[pattern(text, words)])
                    place.append(at)
                    share.append(n / len(words))
                    deal.append(h)
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.float64()), pa.array(deal, pa.float64()), pa.array(place, pa.list_(pa.int64())), pa.array(share, pa.list_(pa.float64()))], ["label", "deal", "place", "share"])

    return run


def train(docs: DataFrame) -> dict:
    """The scorer and the posteriors it was taught, from rows with ``text``."""
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    both = {k: int(n) for k, n in rows.mapInArrow(_patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n")).collect()}
    counts, abuse = Counter(), Counter(dict.fromkeys(range(ABUSE_PATTERNS), 0))
    for k, n in both.items():
        counts[k // ABUSE_PATTERNS] += n
        abuse[k % ABUSE_PATTERNS] += n
    posterior = posteriors(counts)
    # A model taught by no document knows no abuse; a pattern of abstentions alone is none.
    toxic = {k: 1 - p for k, p in posteriors(abuse, ABUSE_LABELLERS).items()} if counts else {}
    sides = [sum(n for k, n in counts.items() if (posterior[k] >= 0.5) == side) for side in (True, False)]
    share = [min(1.0, SAMPLE / n) if n else 0.0 for n in sides]
    # Only rows that may be dealt to the sample go to Python; each side then takes its share of them.
    dealt = rows.withColumn("deal", F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)).where(F.col("deal") < max(share))
    examples = dealt.mapInArrow(_examples(posterior), "label double, deal double, place array<long>, share array<double>")
    picked = [examples.where((F.col("label") >= 0.5) == side).where(F.col("deal") < s).orderBy("deal", "label").limit(SAMPLE) for side, s in zip((True, False), share, strict=True)]
    data = [(np.array(r.place), np.array(r.share), r.label) for r in picked[0].unionByName(picked[1]).collect()]
    weights, bias = fit(data)
    return {"weights": weights.astype(np.float32), "bias": bias, "posterior": posterior, "toxic": toxic | {0: 0.0}}


class _Weights(dict):
    """Weight of each word met, kept while they fit."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > 300_000:
            self.clear()
        a, b = features(word)
        self[word] = out = float(self.weights[a]) + float(self.weights[b])
        return out


def _score(broadcast, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        known = model.setdefault("known", _Weights(model["weights"]))
        for part in slices(batches, TEXT):
            scores, toxic = [], []
            for text in part.column(TEXT).to_pylist():
                words = text.split()
                toxic.append(model["toxic"].get(abuse_pattern(text), 0.0))
                mean = sum(map(known.__getitem__, words)) / len(words) if words else 0.0
                scores.append(float(1 / (1 + np.exp(-np.clip(mean + model["bias"], -50, 50)))) if words else 0.0)
            kept = [s >= KEEP for s in scores]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(scores, pa.float64()), pa.array(kept, pa.bool_()), pa.array(toxic, pa.float64())], [*keep, "quality_score", "quality_kept", "quality_toxic"])

    return run


def model_of(docs: DataFrame):
    return docs.sparkSession.sparkContext.broadcast(train(docs))


def scored(docs: DataFrame, model) -> DataFrame:
    """``docs`` without its text, with quality_score (0 to 1), quality_kept and quality_toxic (0 to 1)."""
    kept = docs.drop("text", "quality_score", "quality_kept", "quality_toxic")
    rows = docs.withColumn(TEXT, F.coalesce("text", F.lit(""))).select(*kept.columns, TEXT)
    fields = [*kept.schema.fields, T.StructField("quality_score", T.DoubleType()), T.StructField("quality_kept", T.BooleanType()), T.StructField("quality_toxic", T.DoubleType())]
    return rows.mapInArrow(_score(model, kept.columns), T.StructType(fields))


def accepted(docs: DataFrame, model, toxic: bool = True) -> DataFrame:
    """The rows of ``docs`` that are kept, with all columns; without ``toxic``, those that are not abusive."""
    kept = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = F.col(kept.columns[docs.columns.index("text")])
    found = scored(kept.withColumn("text", text), model).where(F.col("quality_kept") & (F.lit(toxic) | (F.col("quality_toxic") < TOXIC)))
    return found.select(*[F.col(c).alias(name) for c, name in zip(kept.columns, docs.columns, strict=True)])


def quality(docs: DataFrame) -> DataFrame:
    """For each row of ``docs``: doc_id, score, kept, toxic_score, toxic."""
    found = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model_of(docs))
    return found.select("doc_id", F.col("quality_score").alias("score"), F.col("quality_kept").alias("kept"), F.col("quality_toxic").alias("toxic_score"), (F.col("quality_toxic") >= TOXIC).alias("toxic"))
