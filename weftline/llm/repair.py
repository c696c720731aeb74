"""Repair of conversations' structure: the cheapest edits that make the roles read ``(s?(ua)+)?``.

A conversation's rows, in order of turns, go through a machine with four states: nothing yet, after the system turn, after a user turn,
after an assistant turn. Keeping a row costs 0, giving it the role that is due 1, deleting it 2, inserting an empty turn 5. Blank
rows and repeats are always deleted; a truncated row that stays costs 5 more. Of the cheapest edits those whose letters (D, I, K, R)
are least in ASCII are taken: going forward, the least letter whose cost and the cost of what is left after it
add up to the cost of what is left before it.

The costs of what is left are found backward, and long conversations are cut into chunks that are worked out at once: a chunk does not know the costs
at its end, so it starts from speculative vectors, one for each state it may end in. The costs at its start are then known for
any end, as least sums of these. Where the vectors at its start differ by constants only (those left out that no end can make the least), they do not
depend on what follows.
Fix-up passes join the other chunks with what follows them, twice as far in each pass, until all are of that kind or reach the end of their
conversation. Then each chunk's end vector is that of the next one's start, up to a constant that no choice depends on, and
each chunk is traced forward from every state it may begin in; the states are stitched in the same way from the front.

Nulls are one space, in roles and texts and in the key ``conv_id:turn`` that damage is drawn by; a null turn comes first. Rows of one turn are in an order of their
roles and then of their texts' MD5 sums, a repeated row follows its original; rows alike in all of this may change places. A null conv_id is a
conversation. A role with another initial than s, u and a can only be changed or deleted; an empty role has no initial and is like those.
A conversation without rows after damage has zeros, an empty audit and the hash of the empty text. An empty table gives no row.
Rows are dealt by ranges of (conversation, turn), so a conversation of any length is spread over tasks; a chunk has at most
``ROWS`` rows and about ``BYTES`` bytes of text, one row at least. Only the hash and the audit of a conversation, which are one value for all its rows, are put
together by one task, from its chunks in order, without holding more than a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import based
from weftline.settings import written

ROWS = 4096
BYTES = 4 << 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# States, and the class of a row's role: the state that keeping it leads to.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
DUE = np.array([USER, USER, ASSISTANT, USER])
"""The turn that may be put in, or a row be changed to, in each state."""
ENDS = (NOTHING, ASSISTANT)
CUT_OFF, GONE = 4, 8
"""A row's code: the class of its role (0: another), and whether it is truncated or must go."""
FAR = 1 << 40
"""More than any cost; what cannot be reached."""
BLANKS = " \t\n\x0b\x0c\r"


# --- the machine -----------------------------------------------------------------------------------------------


def _least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of cost matrices (or of a matrix and vectors): least sums. Matrices are in the last two axes."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(-2), FAR)


def _edits(code: int) -> np.ndarray:
    """Costs of a row's deletion, keeping and change, from each state to each."""
    cost = np.full((4, 4), FAR)
    kind, role = code & ~3, code & 3
    for s in range(4):
        cost[s, s] = DELETE
        if kind != GONE:
            more = TRUNCATED if kind == CUT_OFF else 0
            cost[s, DUE[s]] = min(cost[s, DUE[s]], REROLE + more)
            if role == DUE[s] or (role == SYSTEM and s == NOTHING):
                cost[s, role] = min(cost[s, role], KEEP + more)
    return cost


def _insertions() -> np.ndarray:
    cost = np.full((4, 4), FAR)
    cost[range(4), range(4)] = 0
    step = cost.copy()
    step[range(4), DUE] = np.minimum(step[range(4), DUE], INSERT)
    for _ in range(3):
        cost = _least(cost, step)
    return cost


INSERTED = _insertions()
ROW = np.array([_least(INSERTED, _edits(code)) for code in range(12)])
"""By a row's code: costs of what may be put in before it and of its own edit, from state to state."""
END = INSERTED[:, list(ENDS)].min(1)
UNIT = np.where(np.eye(4, dtype=bool), 0, FAR)


class Chunks:
    """Rows' codes of some chunks, worked through together: the longest first, so that those still at work are the first ones."""

    def __init__(self, codes: list[np.ndarray]):
        self.size = np.array([len(c) for c in codes], np.int64)
        self.order = np.argsort(-self.size, kind="stable")
        self.codes = np.concatenate([np.zeros(0, np.uint8), *codes])
        self.base = np.cumsum(self.size) - self.size

    def _live(self, step: int) -> np.ndarray:
        return self.order[: np.searchsorted(-self.size[self.order], -step, "left")]

    def backward(self, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Costs before each row, and after the last one of each chunk, from those at the chunks' ends (chunk, state, vector)."""
        vectors = ends.shape[2]
        before = np.zeros((len(self.codes), 4, vectors), np.int64)
        now = ends.copy()
        for step in range(int(self.size.max()) if len(self.size) else 0):
            live = self._live(step)
            at = self.base[live] + self.size[live] - 1 - step
            now[live] = _least(ROW[self.codes[at]], now[live])
            before[at] = now[live]
        return before, now

    def choices(self, before: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The letter taken before each row in each state, and the state it leads to. An insertion stays before the row."""
        after = np.zeros_like(before)
        after[:-1] = before[1:]
        solid = np.flatnonzero(self.size)
        after[(self.base + self.size - 1)[solid]] = ends[solid]
        state = np.arange(4)
        role, kind = self.codes & 3, self.codes & ~np.uint8(3)
        stays = np.where(kind == GONE, FAR, np.where(kind == CUT_OFF, TRUNCATED, 0))[:, None]
        fits = (role[:, None] == DUE) | ((role[:, None] == SYSTEM) & (state == NOTHING))
        kept = np.where(fits, np.take_along_axis(after, np.broadcast_to(role[:, None].astype(np.int64), after.shape), 1), FAR)
        options = [DELETE + after, INSERT + before[:, DUE], KEEP + stays + kept, REROLE + stays + after[:, DUE]]
        letter = np.argmax(np.stack([o == before for o in options], 2), 2)
        to = np.choose(letter, [state, DUE, np.broadcast_to(role[:, None], letter.shape), DUE])
        return letter, to

    def traced(self, before: np.ndarray, ends: np.ndarray, starts: np.ndarray, last: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Letters of the least cheapest edits of each chunk from state ``starts``, and the state it ends in.

        ``before`` and ``ends`` hold one vector. After the last chunk of a conversation come the turns put in at its end."""
        letter, to = self.choices(before[:, :, 0], ends[:, :, 0])
        n = len(self.size)
        at, state, out = self.base.copy(), starts.copy(), [bytearray() for _ in range(n)]
        live = np.flatnonzero(self.size)
        while len(live):
            chosen = letter[at[live], state[live]]
            state[live] = to[at[live], state[live]]
            for c, x in zip(live.tolist(), chosen.tolist(), strict=True):
                out[c].append(b"DIKR"[x])
            at[live] += chosen != 1
            live = live[at[live] < (self.base + self.size)[live]]
        for c in np.flatnonzero(last & (ends[np.arange(n), state, 0] > 0)).tolist():
            while state[c] not in ENDS:
                state[c] = DUE[state[c]]
                out[c] += b"I"
        return [bytes(x) for x in out], state


def repaired(letters: bytes, state: int, roles: list[str], texts: list[str]) -> list[str]:
    """The rows of a chunk after its edits from ``state``: role and text."""
    out, row = [], 0
    for x in letters:
        if x == ord("K"):
            out.append(f"{roles[row]}:{texts[row]}")
            state = " sua".index(roles[row][0])
        elif x != ord("D"):
            state = int(DUE[state])
            out.append(f"{('user', 'assistant')[state - USER]}:{texts[row] if x == ord('R') else ''}")
        row += x != ord("I")
    return out


def code_of(role: str, text: str) -> int:
    """The code of a row that is no repeat."""
    bare = text.strip(BLANKS)
    return max(" sua".find(role[:1] or " "), 0) | (GONE if not bare else 0 if bare[-1] in ".!?" else CUT_OFF)


def illegal(before: str, after: str) -> bool:
    return before[:1] + after[:1] not in ("su", "ua", "au")


# --- damage ----------------------------------------------------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """The rows after damage: conv_id, turn, role, text, and what orders them: by, hash, row, copy."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat_ws(":", text_of("conv_id"), text_of("turn")).cast("binary")) % 20
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text_of("role").alias("by"), text_of("text").alias("text"), fate.alias("fate"), F.monotonically_increasing_id().alias("row"))
    rows = rows.where("fate != 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("by"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), "by", F.md5(F.col("text").cast("binary")).alias("hash"), "row", F.explode(copies).alias("copy"))


# --- chunks ----------------------------------------------------------------------------------------------------

CHUNK = "conv_id long, part int, seq int, open boolean, codes binary, keys array<binary>, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def _arrow(schema: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in list(kinds.items())}
    return [(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = _arrow(schema)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


class _Chunk:
    def __init__(self, conv_id, seq: int, first: bool):
        self.conv_id, self.seq, self.open = conv_id, seq, first
        self.roles, self.texts, self.codes, self.bytes, self.seen = [], [], bytearray(), 0, set()

    def add(self, role: str, text: str) -> None:
        code = code_of(role, text)
        if not code & GONE:
            if (role, text) in self.seen:
                code = (code & 3) | GONE
            self.seen.add((role, text))
        self.roles.append(role)
        self.texts.append(text)
        self.codes.append(code)
        self.bytes += len(text) + len(role)

    def counts(self) -> list[int]:
        blank = sum(not t.strip(BLANKS) for t in self.texts)
        gone, cut = sum(c >= GONE for c in self.codes), sum(c & CUT_OFF > 0 for c in self.codes)
        return [blank, gone - blank, cut, sum(map(illegal, self.roles, self.roles[1:]))]

    def keys(self) -> list[bytes | None]:
        """Of each row that may be the repeat of one before the chunk, a key of role and text."""
        return [None if c & GONE else sha256(f"{len(r)}:{r}{t}".encode()).digest()[:16] for c, r, t in zip(self.codes, self.roles, self.texts, strict=True)]


def _solved(chunks: list[_Chunk]) -> list[tuple]:
    work = Chunks([np.frombuffer(bytes(c.codes), np.uint8) for c in chunks])
    ends = np.broadcast_to(END[None, :, None], (len(chunks), 4, 1)).copy()
    before, now = work.backward(ends)
    letters, _ = work.traced(before, ends, np.zeros(len(chunks), np.int64), np.ones(len(chunks), bool))
    out = []
    for c, cost, audit in zip(chunks, now[:, NOTHING, 0].tolist(), letters, strict=True):
        digest = sha256("\n".join(repaired(audit, NOTHING, c.roles, c.texts)).encode()).hexdigest()
        out.append((*c.counts(), cost, audit.decode(), digest))
    return out


def _chunked(rows_of_chunk: int, bytes_of_chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order as chunks. A conversation that lies between others of the task in one chunk is worked out at once; others stay open."""
        part, seq, now, whole, held = TaskContext.get().partitionId(), 0, None, [], 0

        def row(c: _Chunk, result: tuple | None) -> tuple:
            if result:
                return c.conv_id, part, c.seq, False, None, None, None, None, *result
            return c.conv_id, part, c.seq, True, bytes(c.codes), c.keys(), c.roles, c.texts, *c.counts(), None, None, None

        def out() -> pa.RecordBatch:
            return _batch([row(c, r) for c, r in zip(whole, _solved(whole), strict=True)], CHUNK)

        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                same = now is not None and now.conv_id == conv_id
                full = same and (len(now.roles) >= rows_of_chunk or now.bytes >= bytes_of_chunk)
                if not same or full:
                    if now is not None:
                        if now.open or full:
                            yield _batch([row(now, None)], CHUNK)
                        else:
                            whole.append(now)
                            held += now.bytes
                        if held > 2 * bytes_of_chunk or len(whole) > rows_of_chunk:
                            yield out()
                            whole, held = [], 0
                    now, seq = _Chunk(conv_id, seq, now is None or same), seq + 1
                now.add(role, text)
        if whole:
            yield out()
        if now is not None:  # what follows in the next task is not known
            yield _batch([row(now, None)], CHUNK)

    return run


def chunks(rows: DataFrame, rows_of_chunk: int = ROWS, bytes_of_chunk: int = BYTES) -> DataFrame:
    """The table of chunks: results of whole conversations, and open chunks with their rows."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("by"), F.col("hash"), F.col("row"), F.col("copy")]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    return written(ranges.mapInArrow(_chunked(rows_of_chunk, bytes_of_chunk), CHUNK), "chunks")


# --- open chunks -----------------------------------------------------------------------------------------------


def _numbered(table: DataFrame) -> DataFrame:
    """Open chunks with ``g``, their place among all chunks; those of a conversation follow each other."""
    parts = written(table.groupBy("part").agg((F.max("seq") + 1).cast("long").alias("n")), "parts")
    base = based(parts, "n", "part").select("part", "base")
    return table.where("open").join(base, "part").withColumn("g", F.col("base") + F.col("seq")).drop("base")


def _without_repeats(open_: DataFrame) -> DataFrame:
    """Codes in which rows that repeat one of an earlier chunk must go, and how many were, or were truncated."""
    seen = open_.select("g", "conv_id", F.posexplode("keys").alias("row", "key")).where("key is not null")
    first = seen.groupBy("conv_id", "key").agg(F.min("g").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = written(first, "first")
    same = (F.col("s.key") == F.col("f.key")) & F.col("s.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("s.g") > F.col("f.first"))
    again = seen.alias("s").join(first.alias("f"), same).groupBy("s.g").agg(F.collect_list("s.row").alias("again"))  # no more rows than a chunk has
    table = open_.select("g", "conv_id", "codes").join(written(again, "again"), "g", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for g, conv_id, codes, again in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                own = np.frombuffer(codes, np.uint8).copy()
                at = np.array(again or [], np.int64)
                cut = int((own[at] & CUT_OFF > 0).sum())
                own[at] = own[at] & 3 | GONE
                before, now = Chunks([own]).backward(UNIT[None])
                rows.append((g, conv_id, own.tobytes(), len(at), -cut, now[0].ravel().tolist()))
            yield _batch(rows, schema)

    schema = "g long, conv_id long, codes binary, more_duplicate long, more_truncated long, costs array<long>"
    return table.mapInArrow(run, schema)


SLACK = 2 * INSERT + DELETE
"""From any state, two insertions and a deletion more at most lead onto the path of any other, so costs of what is left differ by no more."""


def _settled(costs: np.ndarray) -> tuple[np.ndarray, bool]:
    """Costs without the vectors that no end can make the least, and whether those left differ by constants only."""
    kept = costs.copy()
    for c in range(4):
        if any(k != c and (kept[:, k] < FAR).all() and (kept[:, c] >= kept[:, k] + SLACK).all() for k in range(4)):
            kept[:, c] = FAR
    left = kept[:, (kept < FAR).any(0)]
    same = (left < FAR).all() and (left - left[0] == (left - left[0])[:, :1]).all()
    return kept, bool(same)


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last chunk of a conversation knows its end: its costs are one vector, given four times."""
    for batch in batches:
        rows = []
        for g, last, costs in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            table = np.array(costs, np.int64).reshape(4, 4)
            table, done = (np.repeat(_least(table, END[:, None]), 4, 1), True) if last else _settled(table)
            rows.append((g, g + 1, done, table.ravel().tolist()))
        yield _batch(rows, _STITCH)


def _fixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs of a chunk joined with those of what follows it. What reaches a settled chunk is settled."""
    for batch in batches:
        rows = []
        for g, costs, to, done, more in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            table, own = _settled(_least(np.array(costs, np.int64).reshape(4, 4), np.array(more, np.int64).reshape(4, 4)))
            rows.append((g, to, done or own, table.ravel().tolist()))
        yield _batch(rows, _STITCH)


_STITCH = "g long, to long, done boolean, costs array<long>"


def _stitched(work: DataFrame) -> DataFrame:
    """``costs`` of (g, last, costs): from each state at a chunk's start to the end of its conversation, or vectors that differ
    by constants, where what follows does not matter. A pass joins each chunk that is open still with the one its costs reach to."""
    work = written(work.select("g", "last", "costs").mapInArrow(_ended, _STITCH), "stitch")
    while work.where("not done").limit(1).count():
        after = work.select(F.col("g").alias("to"), F.col("to").alias("after"), F.col("done").alias("after_done"), F.col("costs").alias("more"))
        rows = work.where("not done").join(after, "to").select("g", "costs", "after", "after_done", "more")
        work = written(rows.mapInArrow(_fixed, _STITCH).unionByName(work.where("done")), "stitch")
    return work.select("g", "costs")


def _vector(costs: list[int]) -> np.ndarray:
    """One of the vectors in parallel, the least cost 0."""
    table = np.array(costs, np.int64).reshape(4, 4)
    column = table[:, np.argmin(table.min(0))]
    return np.where(column < FAR, column - column.min(), FAR)


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state each chunk ends in, from each state it may begin in."""
    for batch in batches:
        rows = []
        for g, codes, last, costs in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            _, states = _trace(codes, last, costs, range(4))
            rows.append((g, states))
        yield _batch(rows, "g long, states array<int>")


def _trace(codes: bytes, last: bool, costs: list[int] | None, starts) -> tuple[list[bytes], list[int]]:
    n = len(starts)
    work = Chunks([np.frombuffer(codes, np.uint8)] * n)
    ends = np.broadcast_to((END if last else _vector(costs))[None, :, None], (n, 4, 1)).copy()
    before, _ = work.backward(ends)
    letters, states = work.traced(before, ends, np.array(list(starts), np.int64), np.full(n, last))
    return letters, states.tolist()


def _states(moves: DataFrame) -> DataFrame:
    """The state at each chunk's start, from (g, first, states): a pass joins each chunk's moves with those of the chunks before, twice as many each time."""
    work = written(moves.select("g", "states", F.col("first").alias("done"), (F.col("g") - 1).alias("from")), "moves")
    while work.where("not done").limit(1).count():
        prior = work.select(F.col("g").alias("from"), F.col("states").alias("prior"), F.col("from").alias("prior_from"), F.col("done").alias("prior_done"))
        rows = work.where("not done").join(prior, "from")
        rows = rows.select("g", F.expr("transform(prior, s -> states[s])").alias("states"), F.col("prior_done").alias("done"), F.col("prior_from").alias("from"))
        work = written(rows.unionByName(work.where("done")), "moves")
    return work.select((F.col("g") + 1).alias("g"), F.col("states")[NOTHING].alias("start"))


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letters, cost and repaired rows of each chunk."""
    schema = "g long, conv_id long, cost long, letters string, rows array<string>"
    for batch in batches:
        for g, conv_id, codes, last, costs, start, roles, texts in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
            letters, _ = _trace(codes, last, costs, [start])
            stays = sum(TRUNCATED for x, c in zip(letters[0].replace(b"I", b""), codes, strict=True) if x != ord("D") and c & CUT_OFF)
            cost = stays + sum({"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[chr(x)] for x in letters[0])
            yield _batch([(g, conv_id, cost, letters[0].decode(), repaired(letters[0], start, roles, texts))], schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order as conversations: cost, audit and hash."""
    now, known, digest, letters, cost, rows = None, False, None, [], 0, 0
    for batch in batches:
        for conv_id, part_cost, part_letters, part_rows in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if not known or conv_id != now:
                if known:
                    yield _batch([(now, cost, "".join(letters), digest.hexdigest())], _JOINED)
                now, known, digest, letters, cost, rows = conv_id, True, sha256(), [], 0, 0
            for x in part_rows:
                digest.update(("\n" * (rows > 0) + x).encode())
                rows += 1
            letters.append(part_letters)
            cost += part_cost
    if known:
        yield _batch([(now, cost, "".join(letters), digest.hexdigest())], _JOINED)


_JOINED = "conv_id long, cost long, audit string, repaired_sha256 string"


def _closed(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the open chunks: (conv_id, counts) to be added up, and (conv_id, cost, audit, repaired_sha256)."""
    open_ = written(_numbered(table), "open")
    work = written(_without_repeats(open_), "work")
    # Neighbours: the chunk after and the chunk before, where they are of the same conversation.
    other = open_.select((F.col("g") - 1).alias("g"), F.col("conv_id").alias("next_id"), F.col("roles")[0].alias("next_role"), F.lit(True).alias("is_next"))
    earlier = open_.select((F.col("g") + 1).alias("g"), F.col("conv_id").alias("prior_id"), F.lit(True).alias("is_prior"))
    same = lambda name, there: F.coalesce(F.col(there) & F.col("conv_id").eqNullSafe(F.col(name)), F.lit(False))
    places = open_.select("g", "conv_id", F.element_at("roles", -1).alias("role")).join(other, "g", "left").join(earlier, "g", "left")
    pair = F.concat(F.substring("role", 1, 1), F.substring("next_role", 1, 1))
    bad = same("next_id", "is_next") & ~pair.isin("su", "ua", "au")
    places = written(places.select("g", (~same("next_id", "is_next")).alias("last"), (~same("prior_id", "is_prior")).alias("first"), bad.cast("long").alias("more_illegal")), "places")
    work = work.join(places, "g")
    stitched = _stitched(work.select("g", "last", "costs"))
    ends = stitched.select((F.col("g") - 1).alias("g"), F.col("costs").alias("end"))
    work = written(work.drop("costs").join(ends, "g", "left"), "ends")
    moves = work.select("g", "codes", "last", "end").mapInArrow(_forward, "g long, states array<int>")
    starts = _states(moves.join(places.select("g", "first"), "g"))
    traced = work.join(starts, "g", "left").withColumn("start", F.when(F.col("first"), F.lit(NOTHING)).otherwise(F.col("start")))
    told = traced.join(open_.select("g", "roles", "texts"), "g").select("g", "conv_id", "codes", "last", "end", "start", "roles", "texts")
    told = told.mapInArrow(_told, "g long, conv_id long, cost long, letters string, rows array<string>")
    joined = told.repartition("conv_id").sortWithinPartitions("conv_id", "g").select("conv_id", "cost", "letters", "rows").mapInArrow(_joined, _JOINED)
    counts = work.select("conv_id", F.lit(0).cast("long").alias("blank"), F.col("more_duplicate").alias("duplicate"), F.col("more_truncated").alias("truncated"), F.col("more_illegal").alias("illegal"))
    counts = counts.unionByName(open_.select("conv_id", *_COUNTS))
    return counts, joined


# --- results ---------------------------------------------------------------------------------------------------


def repairs(turns: DataFrame, rows: DataFrame | None = None, rows_of_chunk: int = ROWS, bytes_of_chunk: int = BYTES) -> DataFrame:
    """Faults and cheapest repair of each conversation of ``turns`` (conv_id, turn, role, text) after damage.

    ``rows`` takes the place of the damaged rows; it has the columns that ``damaged`` gives."""
    rows = damaged(turns) if rows is None else rows
    table = chunks(rows, rows_of_chunk, bytes_of_chunk)
    counts, joined = _closed(table)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("string")
    whole = table.where("not open")
    turn = rows.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"))
    blank = {c: zero.alias(c) for c in ["gaps", *_COUNTS, "cost"]} | {c: none.alias(c) for c in ("audit", "repaired_sha256")}

    def part(frame: DataFrame, *columns: str) -> DataFrame:
        return frame.select("conv_id", *(F.col(c) if c in columns else x for c, x in blank.items()))

    ids = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    result = ["cost", "audit", "repaired_sha256"]
    parts = part(ids).unionByName(part(turn, "gaps")).unionByName(part(whole, *_COUNTS, *result))
    parts = parts.unionByName(part(counts, *_COUNTS)).unionByName(part(joined, *result))
    sums = [F.coalesce(F.sum(c), zero).alias(c) for c in ["gaps", *_COUNTS, "cost"]]
    empty = F.lit(sha256().hexdigest())
    return parts.groupBy("conv_id").agg(*sums, F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), empty).alias("repaired_sha256"))
