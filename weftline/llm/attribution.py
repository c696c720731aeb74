"""Token counts of sections, from one encoding of the whole document.

A document is encoded once. Each token gets its span of characters, from the first character it holds a byte of to
the last. Tokens and sections of many documents lie on one line of offsets and are joined as sorted intervals.
A token that lies in one section counts there. One that crosses a boundary goes, by the rule named, to

- ``largest``: the section with which it shares most characters, the first among equals;
- ``start`` / ``end``: the section of its first / last character, if that is in a section;
- ``share``: to all it meets, in proportion to the characters shared.

Tokens outside all sections count for section -1, which is given only where there are such tokens. So the counts of a
document add up to those of its whole encoding. Sections are character spans, empty ones hold no token; where
sections overlap, the earlier one (by start, then by end) keeps the overlap. Ends beyond the text mean its end, a null name
or bound drops nothing: a null start is 0, a null end is the end of the text.

A null or empty text has no token, and one empty section where sections are lines. Rows with one key are told apart by
nothing else: each row gives its own rows. Special tokens' strings in a text are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import slices

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern the vocabulary was made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SCHEMA = "doc_id long, section int, start int, end int, n_tokens double, n_crossing long"
Spans = tuple[np.ndarray, np.ndarray]


class Encoder:
    """A byte-level vocabulary, with the length in bytes of each token."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.pattern = pattern
        self.encoding = None

    def __getstate__(self):
        return self.ranks, self.pattern

    def __setstate__(self, state):
        self.ranks, self.pattern = state
        self.encoding = None

    def load(self) -> None:
        if self.encoding is None:
            self.encoding = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})
            self.lengths = np.zeros(max(self.ranks.values(), default=0) + 1, np.int64)
            for piece, rank in self.ranks.items():
                self.lengths[rank] = len(piece)

    def spans(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each token in characters of the joined texts, tokens of each text, and characters of each text."""
        self.load()
        ids, counts = [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            own = self.encoding.encode_ordinary(t)
            counts[i] = len(own)
            ids += own
        ends = np.cumsum(self.lengths[np.array(ids, np.int64)]) if ids else np.zeros(0, np.int64)
        joined = np.frombuffer("".join(texts).encode("utf-8", "replace"), np.uint8)
        chars = np.array([len(t) for t in texts], np.int64)
        if len(joined) != chars.sum():
            character = np.cumsum((joined & 0xC0) != 0x80) - 1  # of each byte
            starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            return character[starts], character[ends - 1] + 1, counts, chars
        return np.concatenate(([0], ends[:-1])) if len(ends) else ends, ends, counts, chars


def attributed(start: np.ndarray, end: np.ndarray, s_start: np.ndarray, s_end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens and crossing tokens of each section, and the section of each token that has one only (-1 without).

    Sections are sorted and do not overlap."""
    solid = np.flatnonzero(s_end > s_start)  # an empty section meets no token
    a, b = s_start[solid], s_end[solid]
    first = np.searchsorted(b, start, "right")
    last = np.searchsorted(a, end, "left") - 1
    place = np.where(first <= last, first, -1)
    n, crossing = np.zeros(len(s_start)), np.zeros(len(s_start), np.int64)
    met = np.flatnonzero(place >= 0)
    over = met[(last[met] > first[met]) | (start[met] < a[first[met]]) | (end[met] > b[first[met]])]
    within = np.ones(len(start), bool)
    within[over] = False
    n[solid] = np.bincount(place[within & (place >= 0)], minlength=len(solid))
    if len(over):
        each = last[over] - first[over] + 1
        token = np.repeat(np.arange(len(over)), each)
        section = first[over][token] + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        t0, t1 = start[over][token], end[over][token]
        shared = np.minimum(t1, b[section]) - np.maximum(t0, a[section])
        if rule == "share":
            weight = shared / np.bincount(token, shared)[token]
        elif rule == "largest":
            best = np.lexsort((section, -shared, token))
            weight = np.zeros(len(token))
            weight[best[np.concatenate(([True], token[best][1:] != token[best][:-1]))]] = 1
        elif rule in ("start", "end"):
            weight = ((a[section] <= t0) if rule == "start" else (b[section] >= t1)).astype(float)
            lost = np.bincount(token, weight) == 0
            place[over[lost]] = -1
        else:
            raise ValueError(f"no such rule: {rule}")
        n[solid] += np.bincount(section, weight, len(solid))
        crossing[solid] = np.bincount(section[weight > 0], minlength=len(solid))
    return n, crossing, place


def lines(text: str) -> Spans:
    """Spans of a text's lines, each with its line end."""
    ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 10) + 1
    ends = np.append(ends, len(text)) if not len(ends) or ends[-1] != len(text) else ends
    return np.concatenate(([0], ends[:-1])), ends


def _disjoint(starts: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sections in order, each without what an earlier one holds, and their original numbers."""
    starts, ends = np.clip(starts, 0, size), np.clip(ends, 0, size)
    order = np.lexsort((ends, starts))
    starts, ends = starts[order], ends[order]
    taken = np.concatenate(([0], np.maximum.accumulate(ends)[:-1])) if len(ends) else ends
    starts = np.maximum(starts, taken)
    return starts, np.maximum(ends, starts), order


def _counted(encoder, cut: Callable[[pa.RecordBatch], list[Spans]], rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = part.column("text").to_pylist()
            start, end, counts, chars = encoder.value.spans(texts)
            given = cut(part)
            cleaned = [_disjoint(a, b, int(c)) for (a, b), c in zip(given, chars, strict=True)]
            sizes = np.array([len(a) for a, _, _ in cleaned], np.int64)
            base = np.cumsum(chars) - chars
            shift = np.repeat(base, sizes)
            flat = [np.concatenate(x).astype(np.int64) for x in zip(*cleaned, strict=True)]
            n, crossing, place = attributed(start, end, flat[0] + shift, flat[1] + shift, rule)
            doc = np.repeat(np.arange(len(texts)), counts)
            outside = np.bincount(doc[place < 0], minlength=len(texts))
            bare = np.flatnonzero(outside)
            rows = np.concatenate((np.repeat(np.arange(len(texts)), sizes), bare))
            # A section is reported with the bounds it was given.
            own = [np.concatenate([x[k][o] for x, (_, _, o) in zip(given, cleaned, strict=True)]) for k in (0, 1)]
            ids = part.column("doc_id").take(pa.array(rows))
            minus = np.full(len(bare), -1)
            columns = [np.concatenate((flat[2], minus)), np.concatenate((own[0], minus)), np.concatenate((own[1], minus))]
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c.astype(np.int32)) for c in columns), pa.array(np.concatenate((n, outside[bare].astype(float)))), pa.array(np.concatenate((crossing, np.zeros(len(bare), np.int64))))],
                ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"],
            )

    return run


def encoder_of(spark, ranks: str = RANKS):
    """The broadcast vocabulary of a file of ranks; its size is that of the file."""
    with open(ranks, "rb") as f:
        return spark.sparkContext.broadcast(Encoder(f.read()))


def by_line(docs: DataFrame, encoder, rule: str = "largest") -> DataFrame:
    """For each line of each row of ``docs``: doc_id, section (from 0), start, end, n_tokens, n_crossing."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_counted(encoder, lambda part: [lines(t) for t in part.column("text").to_pylist()], rule), SCHEMA)


def by_section(docs: DataFrame, sections: str, encoder, rule: str = "largest") -> DataFrame:
    """As ``by_line``, for the column ``sections`` of ``docs``, an array of (start, end); a null array is an empty one.

    A table of spans comes to this form by one aggregation: ``array_sort(collect_list(struct(start, end)))`` by document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col(sections).alias("sections"))

    def cut(part: pa.RecordBatch) -> list[Spans]:
        out = []
        for text, spans in zip(part.column("text").to_pylist(), part.column("sections").to_pylist(), strict=True):
            both = [(s["start"] or 0, len(text) if s["end"] is None else s["end"]) for s in spans or [] if s is not None]
            out.append((np.array([a for a, _ in both], np.int64), np.array([b for _, b in both], np.int64)))
        return out

    return rows.mapInArrow(_counted(encoder, cut, rule), SCHEMA)
