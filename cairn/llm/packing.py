"""Sum-of-squares online packing of tokenised documents into windows of a fixed length.

Each partition of documents is packed on its own, in one pass and without a shuffle. A document of more than a window
is cut into whole windows and a remainder; a remainder goes to the fill level (an empty window is level 0) whose choice
leaves the least sum over levels of the squared count of partially filled windows. A level array holds those counts.
At the end of a partition, or when too many windows are open, the emptier open windows are cut up to fill the others,
so that at most one window of a partition stays partial.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cairn.llm.memory import lean, small_batches

#: Texts of a batch of rows, units that are remembered, and their longest length.
ROWS, REMEMBERED, LONGEST = 256, 300_000, 64
#: A space beside other white space; elsewhere a space starts a unit that is encoded on its own.
BESIDE = re.compile(r" \s|\s ")
ALONE = re.compile(r"(?<=\S) (?=\S)")
#: Up to here the letter and number classes of every Unicode version in use agree.
SETTLED = re.compile("[^\x00-ɏ]")


class ByteBpe(dict):
    """Ids of a byte-level BPE vocabulary file of the ``tokenizers`` library, as little-endian unsigned 32-bit bytes.

    As a dict it remembers the ids of a unit with the space before it. Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        # The usual printable stand-ins of bytes: printable Latin-1 is itself, the others follow from U+0100.
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in own]
        byte = {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(other)}
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if all(c in byte for c in t)}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        order = [model["vocab"][t] for t in merged]
        if order != sorted(order):
            raise ValueError("ids of this vocabulary don't follow the order of its merges")
        self._path = path
        self._encode = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: ranks[t] for t in ranks if len(t) == 1 or ranks[t] >= 256}, special_tokens={}
        ).encode_ordinary
        self._full = None

    def unit(self, text: str) -> bytes:
        if SETTLED.search(text):
            if self._full is None:
                from tokenizers import Tokenizer

                self._full = Tokenizer.from_file(self._path)
                self._full.encode_special_tokens = True
            ids = self._full.encode(text, add_special_tokens=False).ids
        else:
            ids = self._encode(text)
        return np.array(ids, "<u4").tobytes()

    def __missing__(self, part: str) -> bytes:
        ids = self.unit(" " + part)
        if len(part) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        first, *parts = ALONE.split(text) if BESIDE.search(text) else text.split(" ")
        return self.unit(first) + b"".join(map(self.__getitem__, parts))


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    return ByteBpe(path)


class SumOfSquares:
    """Windows of ``capacity``; ``place`` gives the open window that a piece of ``size`` goes to, or None for a new one."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.levels = np.zeros(capacity + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def place(self, size: int) -> int | None:
        room = self.capacity - size
        count = self.levels
        # Growth of the sum of squares, halved and less a constant, for levels 1 to room; a full window isn't counted.
        growth = 2 * (count[1 + size : room + size + 1] - count[1 : room + 1]) + 2
        if room:
            growth[-1] = -2 * count[room] + 1
        growth[count[1 : room + 1] == 0] = np.iinfo(np.int64).max
        best = room - int(np.argmin(growth[::-1])) if room else 0  # of equal ones the fullest
        fresh = 2 * count[size] + 1 if room else 0
        if not room or growth[best - 1] > fresh:
            best, window = 0, None
        else:
            count[best] -= 1
            window = self.open[best].pop()
        if best + size < self.capacity:
            count[best + size] += 1
        return window

    def opened(self, window: int, level: int) -> None:
        self.open[level].append(window)

    def clear(self) -> None:
        self.levels[:] = 0
        self.open = [[] for _ in range(self.capacity + 1)]


Piece = tuple  # (document id, start, ids as bytes, tokens of the document)


class Packer:
    """Packs documents one by one; finished windows come out as lists of pieces."""

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.sums = SumOfSquares(capacity)
        self.windows: dict[int, list[Piece]] = {}
        self.fill: dict[int, int] = {}
        self.next = 0

    def add(self, doc, ids: bytes) -> Iterator[list[Piece]]:
        n = len(ids) // 4
        whole = n - n % self.capacity
        for at in range(0, whole, self.capacity):
            yield [(doc, at, ids[4 * at : 4 * (at + self.capacity)], n)]
        if size := n - whole:
            window = self.sums.place(size)
            if window is None:
                window, self.next = self.next, self.next + 1
                self.windows[window], self.fill[window] = [], 0
            self.windows[window].append((doc, whole, ids[4 * whole :], n))
            self.fill[window] += size
            if self.fill[window] == self.capacity:
                del self.fill[window]
                yield self.windows.pop(window)
            else:
                self.sums.opened(window, self.fill[window])
                if len(self.windows) > self.most_open:
                    yield from self.drain(last=False)

    def drain(self, last: bool = True) -> Iterator[list[Piece]]:
        """Fill the fuller open windows with what the emptier ones hold; the rest stays as one window."""
        order = sorted(self.windows, key=lambda w: (-self.fill[w], w))
        full = sum(self.fill.values()) // self.capacity
        given = deque(p for w in order[full:] for p in self.windows[w])
        for w in order[:full]:
            pieces, room = self.windows[w], self.capacity - self.fill[w]
            while room:
                doc, start, ids, n = given.popleft()
                take = min(room, len(ids) // 4)
                pieces.append((doc, start, ids[: 4 * take], n))
                if 4 * take < len(ids):
                    given.appendleft((doc, start + take, ids[4 * take :], n))
                room -= take
            yield pieces
        self.sums.clear()
        self.windows, self.fill = {}, {}
        if given and last:
            yield list(given)
        elif given:
            window, self.next = self.next, self.next + 1
            level = sum(len(p[2]) for p in given) // 4
            self.windows[window], self.fill[window] = list(given), level
            self.sums.levels[level] += 1
            self.sums.opened(window, level)


NAMES = ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "filled"]


def _pack(path: str, capacity: int, end_id: int, most_open: int, kind: pa.DataType):
    end = np.array([end_id], "<u4").tobytes()
    types = [kind, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 4]

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        packer = Packer(capacity, most_open)
        sequence = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def emit(windows: Iterable[list[Piece]]) -> None:
            nonlocal sequence
            for pieces in windows:
                offset, filled = 0, sum(len(p[2]) for p in pieces) // 4
                for doc, start, ids, n in pieces:
                    rows.append((doc, start, len(ids) // 4, ids, n, sequence, offset, filled))
                    offset += len(ids) // 4
                sequence += 1

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=NAMES)
            rows.clear()
            return batch

        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                for doc, text in zip(part["doc"].to_pylist(), part["raw"].to_pylist()):
                    emit(packer.add(doc, bpe.encode(text or "") + end))
                if len(rows) > 1000:
                    yield flush()
        emit(packer.drain())
        if rows:
            yield flush()
        bpe.clear()  # the next task of this worker may be another operator's

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    most_open: int = 4096,
) -> DataFrame:
    """One row per piece of a document: its place in the document and in a sequence, and its token ids.

    ``tokenizer`` is the path of a byte-level BPE file. A document is its ids and then ``end_id``; null text counts as
    empty, so it is ``end_id`` alone. Each id lies in exactly one piece. ``ids`` holds little-endian unsigned 32-bit
    ids; ``sequence_id`` is unique in the result; ``most_open`` bounds the windows that a task holds open, beyond which
    the emptier ones are cut up to fill the others, as at the end of a partition; ``filled`` is the number of ids in the sequence and
    ``padded_length`` what it takes, ``capacity`` unless ``filled`` is a power of two. Repeated rows are documents of
    their own, a null id stays null, an empty table gives an empty result, and other columns are ignored.
    """
    small_batches(docs.sparkSession)
    base = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("raw"))
    kind = base.schema["doc"].dataType
    shape = f"doc {kind.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, filled long"
    found = base.mapInArrow(_pack(tokenizer, capacity, end_id, most_open, to_arrow_type(kind)), shape)
    power = F.bit_count("filled") == 1
    return found.select(
        F.col("doc").alias(id_col),
        *NAMES[1:],
        F.when(power, F.col("filled")).otherwise(F.lit(capacity)).cast("long").alias("padded_length"),
    )
