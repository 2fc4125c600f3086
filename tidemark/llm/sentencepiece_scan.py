"""SentencePiece encoding and decoding of whole texts, giant ones in parallel.

Method: max-plus parallel scan. A text above ``CHUNK`` characters is cut into chunks that tasks
encode apart. A cut where a word begins needs no state: no piece reaches across. Where a word is longer
than the room for a cut (text without spaces), the cut falls inside it, and the state is the piece
that reaches the cut. For such a chunk, matrix entry (i, j) is minus the number of pieces of the
path from boundary state i to boundary state j, or minus infinity where there is none. Matrices are
multiplied in the max-plus algebra, block by block in parallel and then the blocks, which gives each cut's one state on the best
(here: the only) path; then each chunk traces its own pieces back from its two states alone.

Texts of up to ``CHUNK`` characters are one chunk and never shuffled. Ids equal the library's.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.pieces import SPACE, Pieces, Segments, State, load, normal
from tidemark.llm.storage import stored
from tidemark.llm.words import column, text_slices

CHUNK = 32_768
BLOCK = 64  # matrices that one task multiplies


def cuts(text: str, chunk: int, reach: int) -> list[tuple[int, bool]]:
    """Where to cut a normal text: (position, whether a word begins there).

    The first word start from each multiple of ``chunk`` on, if it comes within half a chunk. Else
    the cut lies inside the word, at least 2 * ``reach`` characters from its spaces.
    """
    out, at = [], 0
    while at + chunk + chunk // 2 < len(text):
        at += chunk
        found = None
        for m in re.finditer(f"(?<!{SPACE}){SPACE}", text[at - 1 : at + chunk // 2]):
            if m.start() > 0:
                found = at - 1 + m.start()
                break
        if found is not None:
            at = found
            out.append((at, True))
        elif SPACE not in text[at - 2 * reach : at + 2 * reach]:
            out.append((at, False))
        # A cut in a run of spaces waits for the next multiple.
    return out


def _states(text: str, cut: int, pieces: Pieces) -> list[State]:
    """Every piece of the text that starts before the cut and ends at it or after it."""
    return [
        (start - cut, end - cut, piece)
        for end in range(cut, min(len(text), cut + pieces.longest) + 1)
        for start, piece in pieces.ends_at(text, end, max(0, cut - pieces.longest))
        if start < cut
    ]


def _trace(last: dict[int, tuple[int, str]], begin: int, end: int) -> list[str]:
    out = []
    while end > begin:
        start, piece = last[end]
        out.append(piece)
        end = start
    return out[::-1]


class Chunk:
    """A part of a normal text with the characters around it that boundary states may need.

    ``text[begin:end]`` is the chunk. ``enter``, ``leave``: whether its cuts lie inside a word.
    """

    def __init__(self, text: str, begin: int, end: int, enter: bool, leave: bool, pieces: Pieces, segments: Segments):
        self.text, self.begin, self.end, self.enter, self.leave = text, begin, end, enter, leave
        self.pieces, self.segments = pieces, segments
        inside = [m.start() for m in re.finditer(f"(?<!{SPACE}){SPACE}", text[begin:end])]
        inside = [begin + i for i in inside if i or not enter]
        # The word a cut opens into ends at the first space; the word the other cut lies in begins at the last.
        self.head = inside[0] if enter and inside else (end if enter else begin)
        self.tail = inside[-1] if leave and inside else (self.head if leave and enter else begin if leave else end)
        self.whole = enter and leave and not inside  # one word runs through

    def entries(self) -> list[State | None]:
        return _states(self.text, self.begin, self.pieces) if self.enter else [None]

    def exits(self) -> list[State | None]:
        return _states(self.text, self.end, self.pieces) if self.leave else [None]

    def _until(self) -> int:
        return min(len(self.text), self.end + self.pieces.longest)

    def _head_paths(self, state: State) -> tuple[int, dict]:
        at = self.begin + state[1]
        return at, self.pieces.paths(self.text, at, state[2], self._until() if self.whole or (self.leave and self.head == self.end) else self.head)

    def matrix(self) -> list[tuple[State | None, State | None, int]]:
        """Finite entries (from, to, minus the number of pieces) of the transfer matrix."""
        entries, exits = self.entries(), self.exits()
        if self.whole:
            out = []
            for i in entries:
                at, last = self._head_paths(i)
                for j in exits:
                    cost = self._reach(i, at, last, j)
                    if cost is not None:
                        out.append((i, j, -cost))
            return out
        # Spaces inside: what comes before them and after them is independent.
        middle = len(self.segments.encode(self.text[self.head : self.tail])) // 4 if self.tail > self.head else 0
        heads = []
        for i in entries:
            if i is None:
                heads.append((i, 0))
            else:
                at, last = self._head_paths(i)
                if at == self.head:
                    heads.append((i, 0))
                elif self.head in last:
                    heads.append((i, len(_trace(last, at, self.head))))
        tails = []
        if self.leave:
            last = self.pieces.paths(self.text, self.tail, None, self._until())
            for j in exits:
                cost = self._reach(None, self.tail, last, j)
                if cost is not None:
                    tails.append((j, cost))
        else:
            tails.append((None, 0))
        return [(i, j, -(a + middle + b)) for i, a in heads for j, b in tails]

    def _reach(self, i: State | None, at: int, last: dict, j: State) -> int | None:
        end = self.end + j[1]
        if i is not None and at == end:
            # One piece reaches both cuts.
            return 0 if self.begin + i[0] == self.end + j[0] else None
        if end in last and last[end] == (self.end + j[0], j[2]):
            return len(_trace(last, at, end))
        return None

    def ids(self, enter: State | None, leave: State | None) -> bytes:
        """Ids from after the piece of the first state through the piece of the second."""
        out: list[str] = []
        if self.whole:
            at, last = self._head_paths(enter)
            end = self.end + leave[1]
            return self.pieces.ids(_trace(last, at, end) if end > at else [])
        if enter is not None:
            at, last = self._head_paths(enter)
            out = _trace(last, at, self.head) if self.head > at else []
        ids = self.pieces.ids(out)
        if self.tail > self.head:
            ids += self.segments.encode(self.text[self.head : self.tail])
        if leave is not None:
            last = self.pieces.paths(self.text, self.tail, None, self._until())
            ids += self.pieces.ids(_trace(last, self.tail, self.end + leave[1]))
        return ids


Matrix = list[tuple[State | None, State | None, int]]


def multiply(first: Matrix, second: Matrix) -> Matrix:
    """Max-plus product: the best value over the states between, for each pair of outer states."""
    onward: dict = {}
    for k, j, value in second:
        onward.setdefault(k, []).append((j, value))
    best: dict = {}
    for i, k, value in first:
        for j, more in onward.get(k, ()):
            if (i, j) not in best or value + more > best[i, j]:
                best[i, j] = value + more
    return [(i, j, value) for (i, j), value in best.items()]


def product(matrices: list[Matrix]) -> Matrix:
    """Product of neighbouring matrices in order, pair by pair: the product is associative."""
    while len(matrices) > 1:
        pairs = [multiply(a, b) for a, b in zip(matrices[::2], matrices[1::2], strict=False)]
        matrices = pairs + matrices[len(pairs) * 2 :]
    return matrices[0]


def combine(matrices: list[Matrix], enter: State | None = None, leave: State | None = None) -> list[tuple]:
    """States (enter, leave) of each matrix on the best path through all of them between two states."""
    score: dict = {enter: 0}
    back = []
    for matrix in matrices:
        best: dict = {}
        for i, j, value in matrix:
            if i in score and (j not in best or score[i] + value > best[j][0]):
                best[j] = (score[i] + value, i)
        back.append({j: i for j, (_, i) in best.items()})
        score = {j: v for j, (v, _) in best.items()}
    state, out = leave, []
    for step in reversed(back):
        out.append((step[state], state))
        state = step[state]
    return out[::-1]


def _giant(chunk: int) -> Column:
    return F.coalesce(F.length("text"), F.lit(0)) > chunk


_STATE = "struct<start:int,end:int,piece:string>"
_CHUNKS = "key long, id {id}, n_chunks int, chunk int, text string, begin int, end int, enter boolean, leave boolean"


def _cut(model: str, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = load(model).pieces.longest
        for batch in batches:
            for key, id_, text in zip(*(column(batch, c).to_pylist() for c in ("key", "id", "text")), strict=True):
                text = normal(text)
                at = [(0, True), *cuts(text, chunk, reach), (len(text), True)]
                rows = []
                for n, ((a, word_a), (b, word_b)) in enumerate(zip(at[:-1], at[1:], strict=True)):
                    low = a if word_a else a - 2 * reach
                    high = b if word_b else b + 2 * reach
                    rows.append((key, id_, len(at) - 1, n, text[low:high], a - low, b - low, not word_a, not word_b))
                for begin in range(0, len(rows), 256):
                    cols = list(zip(*rows[begin : begin + 256], strict=True))
                    types = [pa.int64(), column(batch, "id").type, pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["key", "id", "n_chunks", "chunk", "text", "begin", "end", "enter", "leave"])

    return run


def _chunks(batch: pa.RecordBatch, model: str) -> Iterator[Chunk]:
    segments = load(model)
    for row in zip(*(column(batch, c).to_pylist() for c in ("text", "begin", "end", "enter", "leave")), strict=True):
        yield Chunk(*row, segments.pieces, segments)


def _dump(state: State | None) -> dict | None:
    return None if state is None else {"start": state[0], "end": state[1], "piece": state[2]}


def _read(state: dict | None) -> State | None:
    return None if state is None else (state["start"], state["end"], state["piece"])


_PA_STATE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("piece", pa.string())])
_PA_MATRIX = pa.list_(pa.struct([("enter", _PA_STATE), ("leave", _PA_STATE), ("value", pa.int64())]))


def _matrices(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"enter": _dump(i), "leave": _dump(j), "value": v} for i, j, v in c.matrix()] for c in _chunks(batch, model)]
            yield pa.record_batch([column(batch, "key"), column(batch, "chunk"), pa.array(found, _PA_MATRIX)], names=["key", "chunk", "matrix"])

    return run


def _steps(table: pa.Table) -> list[Matrix]:
    return [[(_read(e["enter"]), _read(e["leave"]), e["value"]) for e in m] for m in table.column("matrix").to_pylist()]


def _product(table: pa.Table) -> pa.Table:
    """A block of neighbouring matrices as one."""
    table = table.sort_by("place")
    made = [{"enter": _dump(i), "leave": _dump(j), "value": v} for i, j, v in product(_steps(table))]
    first = table.slice(0, 1)
    place = pa.array([first.column("block")[0].as_py()], pa.int64())
    return pa.table({"key": first.column("key"), "run": first.column("run"), "place": place, "matrix": pa.array([made], _PA_MATRIX)})


def _between(table: pa.Table) -> pa.Table:
    """The states of each matrix of a block, given those of the block."""
    table = table.sort_by("place")
    states = combine(_steps(table), _read(table.column("from")[0].as_py()), _read(table.column("to")[0].as_py()))
    return pa.table(
        {
            **{c: table.column(c) for c in ("key", "run", "place")},
            "from": pa.array([_dump(i) for i, _ in states], _PA_STATE),
            "to": pa.array([_dump(j) for _, j in states], _PA_STATE),
        }
    )


def _scan(matrices: DataFrame) -> DataFrame:
    """(key, run, place, from, to): the states of every matrix (key, run, place, matrix) on its run's best path.

    Up: blocks of BLOCK neighbours are multiplied into one matrix, level by level, until a run is
    one block. Down: a block's two states give those of its members. No task holds more than BLOCK
    matrices, however long the text.
    """
    longest = matrices.agg(F.max("place")).first()[0]
    block = (F.col("place") / BLOCK).cast("long")
    levels = [matrices.withColumn("block", block)]
    while longest is not None and longest >= BLOCK:
        schema = f"key long, run int, place long, matrix array<struct<enter:{_STATE},leave:{_STATE},value:long>>"
        above = levels[-1].groupBy("key", "run", "block").applyInArrow(_product, schema)
        levels.append(stored(above, "products").withColumn("block", block))
        longest //= BLOCK
    # A run begins and ends where words begin.
    nothing = F.lit(None).cast(_STATE)
    states = levels[-1].withColumn("from", nothing).withColumn("to", nothing)
    for i in range(len(levels) - 1, -1, -1):
        found = states.groupBy("key", "run", "block").applyInArrow(_between, f"key long, run int, place long, `from` {_STATE}, `to` {_STATE}")
        if i:
            below = found.withColumnRenamed("place", "block")
            states = levels[i - 1].join(below, ["key", "run", "block"])
    return found


def _traced(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = zip(column(batch, "from").to_pylist(), column(batch, "to").to_pylist(), strict=True)
            ids = [c.ids(_read(i), _read(j)) for c, (i, j) in zip(_chunks(batch, model), states, strict=True)]
            yield pa.record_batch([column(batch, "key"), column(batch, "id"), column(batch, "chunk"), pa.array(ids, pa.binary())], names=["key", "id", "chunk", "ids"])

    return run


def _short(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = load(model)
        for batch in batches:
            for part in text_slices(column(batch, "text")):
                some = batch.slice(part.start, part.stop - part.start)
                ids = segments.encode_column(column(some, "text"))
                yield pa.record_batch([column(some, "id"), pa.array(ids, pa.binary())], names=["id", "ids"])

    return run


def encode(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(id, ids): the model's ids of each whole text as little-endian 32-bit numbers.

    NULL and empty texts have no ids. Characters without a piece become byte pieces. No start or
    end ids are added. One row per input row, repeated rows and NULL ids included; other columns
    are ignored. The ids of one text make one value, so a text is limited to 2 GB of them.
    """
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = dict(docs.dtypes)["id"]
    short = docs.filter(~_giant(chunk)).mapInArrow(_short(model), f"id {kind}, ids binary")
    # Equal rows are cut alike and encoded once, and counted.
    giant = docs.filter(_giant(chunk)).groupBy("id", "text").agg(F.count("*").alias("times")).withColumn("key", F.xxhash64("id", "text"))
    cut = giant.select("key", "id", "text").mapInArrow(_cut(model, chunk), _CHUNKS.format(id=kind))
    # The chunks of one text go to many tasks. Three readers share them.
    rows = stored(cut.repartition("key", "chunk"), "chunks")
    inner = rows.filter("enter or leave")
    in_order = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    # Only matrices of texts with cuts inside words; a few states a chunk.
    matrices = (
        inner.mapInArrow(_matrices(model), f"key long, chunk int, matrix array<struct<enter:{_STATE},leave:{_STATE},value:long>>")
        .join(rows.filter("n_chunks > 1").select("key", "chunk", "enter", "leave"), ["key", "chunk"])
        .withColumn("first", F.when(~F.col("enter"), F.col("chunk")))
        # Cuts at word starts part a text into independent runs of chunks.
        .withColumn("run", F.max("first").over(in_order))
        .select("key", "run", (F.col("chunk") - F.col("run")).cast("long").alias("place"), "matrix")
    )
    states = _scan(stored(matrices, "matrices")).select("key", (F.col("run") + F.col("place")).cast("int").alias("chunk"), "from", "to")
    traced = rows.join(states, ["key", "chunk"], "left").mapInArrow(_traced(model), f"key long, id {kind}, chunk int, ids binary")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])
    whole = traced.groupBy("key").agg(F.first("id", ignorenulls=True).alias("id"), parts.alias("parts"))
    whole = whole.withColumn("ids", F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b)))
    times = giant.select("key", "times")
    whole = whole.join(times, "key").withColumn("_", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))).select("id", "ids")
    return short.unionByName(whole).withColumnRenamed("id", id_column)


def _text(blob: bytes | None, out: list[bytes]) -> str:
    raw = b"".join(map(out.__getitem__, np.frombuffer(blob or b"", dtype="<u4").tolist()))
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def _decode(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = load(model).pieces.out
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                some = batch.slice(begin, 512)
                texts = [_text(blob, out) for blob in column(some, "ids").to_pylist()]
                yield pa.record_batch([*some.columns, pa.array(texts, pa.string())], names=[*some.schema.names, "decoded"])

    return run


def decode(coded: DataFrame, model: str) -> DataFrame:
    """The input with ``decoded``: the text of its ``ids``. NULL ids give an empty text; bytes that
    aren't UTF-8 become U+FFFD. A column named ``decoded`` is replaced."""
    coded = coded.drop("decoded")
    schema = ", ".join(f"`{n}` {t}" for n, t in coded.dtypes)
    return coded.mapInArrow(_decode(model), f"{schema}, decoded string")


def _digests(ids: pa.Array, blobs: list[bytes], out: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch(
        [
            ids,
            pa.array([len(b) // 4 for b in blobs], pa.int64()),
            pa.array([zlib.crc32(b) for b in blobs], pa.int64()),
            pa.array([hashlib.sha256(_text(b, out).encode()).hexdigest() for b in blobs], pa.string()),
            pa.array(blobs, pa.binary()),
        ],
        names=["id", "n_tokens", "ids_crc32", "decoded_sha256", "ids"],
    )


def _round_trip(model: str, encoded: bool):
    """Map task: texts, or the ids of them, to their digests; one worker does both ways."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = load(model)
        for batch in batches:
            for part in text_slices(column(batch, "ids" if encoded else "text")):
                some = batch.slice(part.start, part.stop - part.start)
                values = column(some, "ids" if encoded else "text")
                blobs = values.to_pylist() if encoded else segments.encode_column(values)
                yield _digests(column(some, "id"), blobs, segments.pieces.out)

    return run


def round_trip(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(id, n_tokens, ids_crc32, decoded_sha256, ids): each text encoded, and what decoding gave, in short."""
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = f"id {dict(docs.dtypes)['id']}, n_tokens long, ids_crc32 long, decoded_sha256 string, ids binary"
    short = docs.filter(~_giant(chunk)).mapInArrow(_round_trip(model, False), schema)
    giant = encode(docs.filter(_giant(chunk)), model, "id", "text", chunk).mapInArrow(_round_trip(model, True), schema)
    return short.unionByName(giant).withColumnRenamed("id", id_column)
