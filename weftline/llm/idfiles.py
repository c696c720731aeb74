"""Token ids in files of Simple-8b words, written in the order of documents and read back by blocks.

A word of 64 bits holds a selector in its upper 4 bits and as many ids of one width as fit in the other 60. Ids are cut
into blocks of ``BLOCK``; a block starts at a word, the last word of a block may hold padding. An id of 60 bits or more is an
escape: its word holds the selector 0 and no value, and the value follows the block's words as a word of its own. So a block
is decoded on its own, all words of one selector at once.

A file holds ``MAGIC``, the words, and an index: the first word of each block (one more for the end), the number of a block's
words that are not escaped values, the key of each document, whether it is null, and the first id of each document (one more
for the end). Its last 40 bytes are the numbers of blocks, documents and ids, the place of the index, and ``MAGIC``.

Documents are dealt by ranges of their keys, and each task writes its range in files of bounded size. The files that count are
those that the tasks' reports name, so what an attempt of a lost executor left is never read. Rows of one key follow each other in an
order of their texts' hashes, and a key's rows may be in several files. A null key comes first. A null or empty text has the end
id alone. A very long text is one encoding; its ids go to the file by blocks. An empty table writes no file and reads as no row.

Ids are those of the whole text. ``cut`` names bytes that no token of the tokenizer holds or crosses, ``before`` those that no token crosses from a letter
on, ``lower`` says that it takes A-Z for a-z; distinct stretches between such places are encoded once, and their ids are put
together, which gives the same ids. ``cut=b""`` encodes text by text.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import based, lists, slices, words
from weftline.settings import shared_dir, written

TOKENIZER = "word_bpe_49k.json"
CUT, BEFORE = b" \n", b".,;:!?"
END = 2
BLOCK = 256
AT_ONCE = 1 << 20
"""Ids that are packed or unpacked at once: whole blocks."""
FILE = 8 << 20
"""Ids after which a task begins another file, at the next document."""
KNOWN = 600_000
"""Stretches whose ids a worker remembers, about."""
MAGIC = b"WFTIDS01"
# Values in a word and bits of each, by selector; selector 0 is an escape, 1 a run of zeros.
COUNT = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTH = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_PAYLOAD = np.uint64((1 << 60) - 1)
_SHIFT = np.uint64(60)


# --- words of a block ------------------------------------------------------------------------------------------


def packed(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the blocks of ``ids`` (64-bit, unsigned), and of each block the number of all words and of those that are no escaped value."""
    blocks = -(-len(ids) // BLOCK)
    table = np.zeros((blocks, BLOCK), np.uint64)
    table.reshape(-1)[: len(ids)] = ids
    size = np.full(blocks, BLOCK)
    if blocks:
        size[-1] = len(ids) - BLOCK * (blocks - 1)
    escaped = table > _PAYLOAD
    # Rounding to doubles can only lengthen a value by a bit, which the last width takes.
    bits = np.where(escaped, 61, np.minimum(np.frexp(table.astype(float))[1], 60)).astype(np.int16)
    place = np.arange(BLOCK, dtype=np.int16)
    selector = np.zeros((blocks, BLOCK), np.uint8)
    for s in range(len(COUNT) - 1, 0, -1):  # the later choice, of more values a word, overwrites
        misfit = np.where(bits > WIDTH[s], place, np.int16(BLOCK + COUNT[1]))
        first = np.minimum.accumulate(misfit[:, ::-1], 1)[:, ::-1]
        selector[first - place >= COUNT[s]] = s
    # All blocks take their next word at each step.
    at, live, taken = np.zeros(blocks, np.int64), np.arange(blocks), []
    while len(live):
        taken.append((live, at[live]))
        at[live] += COUNT[selector[live, at[live]]]
        live = live[at[live] < size[live]]
    block, start = (np.concatenate(x) for x in zip(*taken, strict=True)) if taken else (np.zeros(0, np.int64),) * 2
    order = np.argsort(block, kind="stable")
    block, start = block[order], start[order]
    chosen = selector[block, start]
    out = chosen.astype(np.uint64) << _SHIFT
    wide = np.concatenate((table, np.zeros((blocks, COUNT[1]), np.uint64)), 1)
    for s in range(2, len(COUNT)):
        own = np.flatnonzero(chosen == s)
        if len(own):
            values = wide[block[own][:, None], start[own][:, None] + np.arange(COUNT[s])]
            out[own] |= np.bitwise_or.reduce(values << (np.arange(COUNT[s]) * WIDTH[s]).astype(np.uint64), 1)
    plain = np.bincount(block, minlength=blocks)
    raw_block, raw_at = np.nonzero(escaped)
    # An escape's value goes behind the words of its block.
    everything = np.concatenate((out, table[raw_block, raw_at]))
    order = np.argsort(np.concatenate((2 * block, 2 * raw_block + 1)), kind="stable")
    return everything[order], plain + np.bincount(raw_block, minlength=blocks), plain


def unpacked(data: np.ndarray, total: np.ndarray, plain: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of blocks that all but the last are full: the inverse of ``packed``."""
    blocks = len(total)
    block = np.repeat(np.arange(blocks), total)
    within = np.arange(len(data)) - np.repeat(np.cumsum(total) - total, total)
    is_word = within < plain[block]
    word, raws, block = data[is_word], data[~is_word], block[is_word]
    selector = (word >> _SHIFT).astype(np.int64)
    count = COUNT[selector]
    after = np.cumsum(count)
    first = np.concatenate(([0], np.cumsum(plain)[:-1])).astype(np.int64)
    start = after - count
    start = start - start[first][block] if len(word) else start
    out = np.zeros((blocks, BLOCK + COUNT[1]), np.uint64)
    for s in range(2, len(COUNT)):
        own = np.flatnonzero(selector == s)
        if len(own):
            values = (word[own][:, None] >> (np.arange(COUNT[s]) * WIDTH[s]).astype(np.uint64)) & np.uint64((1 << int(WIDTH[s])) - 1)
            out[block[own][:, None], start[own][:, None] + np.arange(COUNT[s])] = values
    own = np.flatnonzero(selector == 0)
    out[block[own], start[own]] = raws
    return out[:, :BLOCK].reshape(-1)[:n]


# --- files -----------------------------------------------------------------------------------------------------


class Writer:
    """One file, written as ids come."""

    def __init__(self, out):
        self.out, self.pending, self.waiting, self.ids, self.at = out, [], 0, 0, 0
        self.sizes, self.plain, self.keys, self.starts = [], [], [], []
        out.write(MAGIC)

    def add(self, keys: list[int | None], counts: np.ndarray, ids: np.ndarray) -> None:
        """Documents with these keys and numbers of ids, and the ids of all."""
        self.keys += keys
        self.starts.append(self.ids + np.cumsum(counts) - counts)
        self.pending.append(ids)
        self.ids += len(ids)
        self.waiting += len(ids)
        if self.waiting >= AT_ONCE:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, np.uint64)
        full = len(ids) if last else len(ids) // BLOCK * BLOCK
        for i in range(0, full, AT_ONCE):
            data, total, plain = packed(ids[i : min(i + AT_ONCE, full)].astype(np.uint64))
            self.out.write(data.astype("<u8").tobytes())
            self.sizes.append(total)
            self.plain.append(plain)
        self.pending, self.waiting = [ids[full:]], len(ids) - full

    def close(self) -> None:
        self._flush(True)
        total = np.concatenate([np.zeros(1, np.int64), *self.sizes])
        plain = np.concatenate([np.zeros(0, np.int64), *self.plain])
        keys = np.array([0 if k is None else k for k in self.keys], "<i8")
        null = np.array([k is None for k in self.keys], np.uint8)
        starts = np.append(np.concatenate([np.zeros(0, np.int64), *self.starts]), self.ids)
        place = len(MAGIC) + 8 * int(total.sum())
        for part in (np.cumsum(total).astype("<u8"), plain.astype("<u4"), keys, null, starts.astype("<u8")):
            self.out.write(part.tobytes())
        self.out.write(np.array([len(plain), len(keys), self.ids, place], "<u8").tobytes() + MAGIC)
        self.out.close()


class Reader:
    """A file read by ranges; ``f`` has ``size()`` and ``read_at(length, offset)``."""

    def __init__(self, f):
        self.f = f
        size = f.size()
        tail = f.read_at(40, size - 40)
        if tail[32:] != MAGIC:
            raise ValueError("not a file of ids")
        blocks, docs, self.ids, place = (int(x) for x in np.frombuffer(tail[:32], "<u8"))
        index, at = f.read_at(size - 40 - place, place), 0
        parts = []
        for kind, n in (("<u8", blocks + 1), ("<u4", blocks), ("<i8", docs), ("u1", docs), ("<u8", docs + 1)):
            parts.append(np.frombuffer(index, kind, n, at))
            at += parts[-1].nbytes
        self.block, self.plain, self.keys, null, starts = parts
        self.null, self.starts = null.astype(bool), starts.astype(np.int64)

    def blocks(self, a: int, b: int) -> np.ndarray:
        """Ids of the blocks from ``a`` up to, not with, ``b``."""
        from_, to = int(self.block[a]), int(self.block[b])
        data = np.frombuffer(self.f.read_at(8 * (to - from_), len(MAGIC) + 8 * from_), "<u8")
        total = np.diff(self.block[a : b + 1].astype(np.int64))
        return unpacked(data, total, self.plain[a:b].astype(np.int64), min(self.ids, b * BLOCK) - a * BLOCK)

    def span(self, a: int, b: int) -> np.ndarray:
        """Ids ``a`` up to, not with, ``b``; only their blocks are read."""
        if a == b:
            return np.zeros(0, np.uint64)
        first = a // BLOCK
        return self.blocks(first, -(-b // BLOCK))[a - first * BLOCK : b - first * BLOCK]

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """The file's ids in stretches: the number of a document, the place of the stretch's first id, its ids. A document may have several."""
        for from_ in range(0, max(self.ids, 1), AT_ONCE):
            to = min(self.ids, from_ + AT_ONCE)
            ids = self.span(from_, to)
            doc = int(np.searchsorted(self.starts, from_, "right")) - 1
            while doc < len(self.keys) and (self.starts[doc] < to or self.starts[doc] == self.starts[doc + 1] == to == self.ids):
                a, b = max(from_, int(self.starts[doc])), min(to, int(self.starts[doc + 1]))
                yield doc, a, ids[a - from_ : b - from_]
                doc += 1


# --- encoding --------------------------------------------------------------------------------------------------


class Encoder:
    """Ids of texts by a tokenizer file's content; loaded once a worker."""

    def __init__(self, content: str, cut: bytes = CUT, before: bytes = BEFORE, lower: bool = True):
        self.content, self.cut, self.before, self.lower, self.tokenizer = content, cut, before, lower, None

    def __getstate__(self):
        return self.content, self.cut, self.before, self.lower

    def __setstate__(self, state):
        self.content, self.cut, self.before, self.lower = state
        self.tokenizer = None

    def _of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and their number by text."""
        if self.tokenizer is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer, self.last = Tokenizer.from_str(self.content), None
            if suffix := getattr(self.tokenizer.model, "end_of_word_suffix", None):
                self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
                self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
            self._forget()
        each = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(each), np.uint32), np.fromiter(map(len, each), np.int64, len(each))

    def _forget(self) -> None:
        """What is known: the number of each stretch, where its ids begin and end among all, and these (with room for more)."""
        self.known, self.first, self.flat = {}, np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _learn(self, stretches: list[bytes]) -> None:
        ids, sizes = self._of_many([w.decode() for w in stretches])
        end = int(self.first[-1])
        if end + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat[:end], np.zeros(end + 2 * len(ids), np.uint32)))
        self.flat[end : end + len(ids)] = ids
        self.known.update(zip(stretches, range(len(self.known), len(self.known) + len(stretches)), strict=True))
        self.first = np.concatenate((self.first, end + np.cumsum(sizes)))

    def _of_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_of``. Texts of letters alone go many at a time, where the tokenizer marks the last token of each word: each is one word of it."""
        if self.last is None:
            return self._of(texts)
        simple = np.fromiter(map(str.isalpha, texts), bool, len(texts))
        one, other = np.flatnonzero(simple).tolist(), np.flatnonzero(~simple).tolist()
        ids, _ = self._of([" ".join([texts[k] for k in one[i : i + 256]]) for i in range(0, len(one), 256)])
        ends = np.flatnonzero(self.last[ids])
        if len(ends) != len(one) or (len(ids) and ends[-1] + 1 != len(ids)):
            return self._of(texts)
        rest, sizes = self._of([texts[k] for k in other])
        place = np.argsort(np.array(one + other, np.int64))
        size = np.concatenate((np.diff(ends, prepend=-1), sizes))
        start = (np.cumsum(size) - size)[place]
        size = size[place]
        return np.concatenate((ids, rest))[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())], size

    def _lowered(self, texts: pa.Array) -> pa.Array:
        """The texts in lower case (A-Z), if that makes no special token of what is none."""
        raw = texts.cast(pa.binary())
        ends = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1]
        data = (raw.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[ends[0] : ends[-1]].lower()
        if any(t.content.lower().encode() in data for t in self.tokenizer.get_added_tokens_decoder().values()):
            return texts
        return pa.BinaryArray.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(data)])

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and their number by text."""
        if not self.cut:
            return self._of(texts.to_pylist())
        self._of([])
        found, row, _ = words(self._lowered(texts) if self.lower else texts, self.cut, before=self.before)
        found = found.dictionary_encode()
        distinct = found.dictionary.to_pylist()
        if len(self.known) > KNOWN:
            self._forget()
        number = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        if len(new := np.flatnonzero(number < 0)):
            number[new] = len(self.known) + np.arange(len(new))
            self._learn([distinct[i] for i in new.tolist()])
        number = number[found.indices.to_numpy(zero_copy_only=False)]
        start = self.first[number]
        n = self.first[number + 1] - start
        ids = self.flat[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return ids, np.bincount(row, n, len(texts)).astype(np.int64)


def encoder_of(spark: SparkSession, file: str = TOKENIZER, cut: bytes = CUT, before: bytes = BEFORE, lower: bool = True):
    """The broadcast encoder of a tokenizer's file; its size is that of the file."""
    with open(public_tokenizers.path(file), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(Encoder(f.read(), cut, before, lower))


def _with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    return np.insert(ids, np.cumsum(counts), end)


# --- Spark jobs ------------------------------------------------------------------------------------------------


def _write(folder: str, encoder, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        part, seq, writer, name = TaskContext.get().partitionId(), 0, None, ""

        def report() -> pa.RecordBatch:
            writer.close()
            row = [[part], [seq], [f"{folder}/{name}"], [len(writer.keys)], [writer.ids]]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["part", "seq", "path", "docs", "ids"])

        for batch in slices(batches, "text", 4 << 20):
            if writer is None:
                name = f"{uuid.uuid4()}.ids"
                writer = Writer(system.open_output_stream(f"{path}/{name}"))
            ids, counts = encoder.value.encoded(batch.column("text"))
            writer.add(batch.column("doc_id").to_pylist(), counts + 1, _with_end(ids, counts, end))
            if writer.ids >= FILE:
                yield report()
                writer, seq = None, seq + 1
        if writer is not None:
            yield report()

    return run


def write(docs: DataFrame, encoder, end: int = END) -> DataFrame:
    """Files of the rows (doc_id, text) in the shared folder: part, seq, path, docs, ids, and ``base``, the ids of all files before."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/ids-{uuid.uuid4()}"
    if "://" not in folder:
        folder = f"file://{folder}"
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path)
    text = F.coalesce("text", F.lit(""))
    # The hash and the row's number deal out the rows of one key, however many; rows alike in both columns may change places.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("row")]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    files = written(ranges.mapInArrow(_write(folder, encoder, end), "part int, seq int, path string, docs long, ids long"), "files")
    return based(files, "ids", "part", "seq")


def _opened(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
            with _opened(uri) as f:
                file = Reader(f)
                crc = np.zeros(len(file.keys), np.int64)
                for doc, _, ids in file.documents():
                    crc[doc] = zlib.crc32(ids.astype("<u4").tobytes(), int(crc[doc]))
                keys = pa.array(file.keys.astype(np.int64), mask=file.null)
                yield pa.RecordBatch.from_arrays([keys, pa.array(base + file.starts[:-1]), pa.array(np.diff(file.starts)), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            with _opened(uri) as f:
                file, a = Reader(f), 0
                while a < len(file.keys):  # documents of about AT_ONCE ids, one at least
                    b = max(a + 1, int(np.searchsorted(file.starts, file.starts[a] + AT_ONCE, "right")) - 1)
                    ids = file.span(int(file.starts[a]), int(file.starts[b])).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(file.keys[a:b].astype(np.int64), mask=file.null[a:b]), lists(ids, np.diff(file.starts[a : b + 1]))], ["doc_id", "ids"])
                    a = b


def _by_file(files: DataFrame) -> DataFrame:
    files = written(files.select("path", "base"), "bases")
    return files.repartition(max(1, files.count()))


def digests(files: DataFrame) -> DataFrame:
    """Of each document in the files: doc_id, start, n_tokens, ids_crc32."""
    return _by_file(files).mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read(files: DataFrame) -> DataFrame:
    """The documents in the files with their ids."""
    return _by_file(files).mapInArrow(_lists, "doc_id long, ids array<long>")
