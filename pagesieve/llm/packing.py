"""Hierarchical multi-length packing of token sequences.

Documents are tokenised. Whole windows of the largest size are cut off a document
as they are. What remains is routed to the smallest of several context sizes that
holds it. Each size is packed, the largest first: a window is opened by the
longest document of its size, its gap is filled with whole documents of shorter
sizes (best fit), and what gap is left by a piece cut from a short document, whose
rest is routed again. All sizes are powers of two, so a full window of a smaller
size needs no padding either; at most one window of a cell is not full. Windows
are dealt to steps of about equal token counts, longest first and back and forth.

Documents are dealt to cells of about ``CELL_DOCS`` documents by a hash; each cell
is packed on its own, so the work is spread whatever the documents are like. Only
remainders' ids are shuffled, two bytes each if the vocabulary allows; ids of
whole windows only as checksums.

A tokenizer that never joins text across ASCII blanks gives the same ids word by
word, so a word's ids are looked up after its first time; the operator is meant
for such tokenizers.

Cases: null and empty text is the end mark alone. Repeated rows are packed as
often as they occur. Null ids are kept. Empty table: no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SIZES = (2048, 1024, 512, 256)
CELL_DOCS = 1024
STEP_TOKENS = 32 * 2048
END = 1
WORD_END = "</w>"
MAX_CACHED_WORDS = 700_000

Piece = tuple[int, int, int]  # item, start, length


def _letters(word: bytes) -> bool:
    """Whether a word is of letters alone, before and after lower-casing."""
    if word.isascii():
        return word.isalpha()
    text = word.decode("utf-8")
    return text.isalpha() and text.lower().isalpha()


class WordTokens(dict):
    """Word (bytes between ASCII blanks) -> its ids as bytes; emptied when it has grown too far.

    Words are tokenised without capitals and closing marks: the tokenizer lower-cases
    A-Z and never joins letters with marks. A word that holds the opening of a special
    token is taken as it is.
    """

    def __init__(self, path: str):
        super().__init__()
        self._tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 65536 else "<u4")
        self._end = np.array([END], self.dtype).tobytes()
        self._closing = np.zeros(self._tokenizer.get_vocab_size(), bool)  # ids that end a word
        for token, number in self._tokenizer.get_vocab().items():
            self._closing[number] = token.endswith(WORD_END)

    @staticmethod
    def parts(word: bytes) -> tuple[bytes, ...]:
        """What a word's ids are put together from."""
        if b"<|" in word:
            return (word,)
        low = word.lower()
        core = low.rstrip(b".,!?;:#$%&*")
        return (core, low[len(core):]) if core != low and _letters(core) else (low,)

    def learn(self, found: set[bytes]) -> None:
        """Tokenise the words that are new: those of letters alone as one text, cut after
        closing ids, the others one by one in a single call."""
        new = {p for w in found if w not in self for p in self.parts(w) if p not in self}
        plain, others = [], []
        for w in new:
            (plain if _letters(w) else others).append(w)
        if plain:
            made = self._tokenizer.encode_batch_fast([b" ".join(plain).decode("utf-8")], add_special_tokens=False)[0]
            ids = np.array(made.ids, self.dtype)
            cuts = np.flatnonzero(self._closing[ids]) + 1
            if len(cuts) == len(plain):
                self._store(plain, ids, [0, *cuts.tolist()])
            else:  # a letter's lower case is not one letter
                others += plain
        if others:
            made = self._tokenizer.encode(
                [w.decode("utf-8") for w in others], is_pretokenized=True, add_special_tokens=False)
            cuts = np.searchsorted(np.array(made.word_ids, np.int64), np.arange(len(others) + 1))
            self._store(others, np.array(made.ids, self.dtype), cuts.tolist())

    def _store(self, words: list[bytes], ids: np.ndarray, cuts: list[int]) -> None:
        data, width = ids.tobytes(), ids.itemsize
        for word, a, b in zip(words, cuts, cuts[1:], strict=False):
            self[word] = data[a * width:b * width]

    def __missing__(self, word: bytes) -> bytes:
        value = self[word] = b"".join([self[p] for p in self.parts(word)])
        return value

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Ids of texts, the end mark included."""
        if len(self) > MAX_CACHED_WORDS:
            self.clear()
        found = [(t or "").encode("utf-8").split() for t in texts]
        self.learn(set(chain.from_iterable(found)))
        return [np.frombuffer(b"".join(map(self.__getitem__, w)) + self._end, self.dtype) for w in found]


@cache
def word_tokens(path: str) -> WordTokens:
    """One table per worker process, kept from task to task."""
    return WordTokens(path)


def batches_of(texts: Sequence[str | None], size: int = 3_000_000) -> Iterator[Sequence[str | None]]:
    """Consecutive texts of about ``size`` characters together."""
    start = total = 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= size:
            yield texts[start:i + 1]
            start, total = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def checksum(ids: np.ndarray) -> int:
    """crc32 over the ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


class _Pools:
    """What is still to pack: per size a sorted list of ``(length, item, start)``."""

    def __init__(self, lengths: Sequence[int], sizes: Sequence[int]):
        self.sizes = sorted(sizes)
        self.lists: dict[int, list[tuple[int, int, int]]] = {s: [] for s in self.sizes}
        for item, n in sorted(enumerate(lengths), key=lambda x: (x[1], x[0])):
            self.lists[self.size_of(n)].append((n, item, 0))

    def size_of(self, n: int) -> int:
        return next(s for s in self.sizes if n <= s)

    def best_fit(self, gap: int, below: int) -> tuple[int, int, int] | None:
        """The longest piece that fits ``gap`` whole, of sizes up to ``below``."""
        for size in reversed(self.sizes):
            pool = self.lists[size]
            if size <= below and (at := bisect_right(pool, (gap, float("inf"), 0))):
                return pool.pop(at - 1)
        return None

    def cut(self, gap: int, below: int) -> tuple[int, int, int] | None:
        """``gap`` tokens of the longest piece of the shortest size that has any; the rest stays."""
        for size in self.sizes:
            if size <= below and self.lists[size]:
                n, item, start = self.lists[size].pop()
                rest = n - gap
                insort(self.lists[self.size_of(rest)], (rest, item, start + gap))
                return gap, item, start
        return None


def pack(lengths: Sequence[int], sizes: Sequence[int] = SIZES) -> list[tuple[int, list[Piece]]]:
    """Items of ``lengths`` (each at most the largest size) -> ``(size, pieces)`` per window."""
    pools, windows = _Pools(lengths, sizes), []
    for size in sorted(sizes, reverse=True):
        while pools.lists[size]:
            n, item, start = pools.lists[size].pop()
            pieces, gap = [(item, start, n)], size - n
            while gap:
                # whatever fits nowhere whole is longer than the gap, so it can be cut
                part = pools.best_fit(gap, size) or pools.cut(gap, size)
                if part is None:
                    break
                length, item, start = part
                pieces.append((item, start, length))
                gap -= length
            windows.append((size, pieces))
    return windows


def steps(window_tokens: Sequence[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step number per window; windows are dealt longest first, forth and back."""
    n = max(1, round(sum(window_tokens) / step_tokens))
    out = [0] * len(window_tokens)
    for k, i in enumerate(sorted(range(len(window_tokens)), key=lambda i: (-window_tokens[i], i))):
        turn, at = divmod(k, n)
        out[i] = at if turn % 2 == 0 else n - 1 - at
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   sizes: Sequence[int] = SIZES, cell_docs: int = CELL_DOCS) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``,
    ``context_size`` and ``step``."""
    id_type = docs.schema[id_col].dataType.simpleString()
    largest = max(sizes)
    cells = docs.count() // cell_docs + 1

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_tokens(tokenizer_path)
        for batch in batches:
            totals, sums, tails = [], [], []
            for ids in chain.from_iterable(map(table.encode, batches_of(batch.column(2).to_pylist()))):
                whole = len(ids) // largest * largest
                totals.append(len(ids))
                sums.append([checksum(ids[i:i + largest]) for i in range(0, whole, largest)])
                tails.append(ids[whole:].tobytes())
            width = pa.array([table.dtype.itemsize] * batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(totals, pa.int64()),
                 pa.array(sums, pa.list_(pa.int64())), pa.array(tails, pa.binary()), width],
                names=["cell", id_col, "total", "sums", "tail", "width"])

    def packed(table: pa.Table) -> pa.Table:
        cell = table.column("cell")[0].as_py()
        tails = table.column("tail").to_pylist()
        keys = table.column(id_col).to_pylist()
        order = sorted(range(len(tails)), key=lambda i: (keys[i] is None, keys[i] or 0, len(tails[i]), tails[i]))
        totals, sums = table.column("total").to_pylist(), table.column("sums").to_pylist()
        width = table.column("width")[0].as_py()
        ids = {i: np.frombuffer(tails[i], f"<u{width}") for i in order}
        windows, rows = [], []  # rows: document, start, length, crc, window, offset
        for i in order:
            for k, crc in enumerate(sums[i]):
                rows.append((i, k * largest, largest, crc, len(windows), 0))
                windows.append((largest, largest))
        rest = [i for i in order if len(ids[i])]
        for size, pieces in pack([len(ids[i]) for i in rest], sizes):
            offset = 0
            for item, start, length in pieces:
                i = rest[item]
                rows.append((i, totals[i] - len(ids[i]) + start, length,
                             checksum(ids[i][start:start + length]), len(windows), offset))
                offset += length
            windows.append((size, offset))
        step = steps([n for _, n in windows])
        doc, start, length, crc, window, offset = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        per_window = lambda values: np.array(values, np.int64)[window]
        return pa.table({
            id_col: table.column(id_col).take(pa.array(doc)), "start": start, "length": length, "ids_crc32": crc,
            "doc_tokens": np.array(totals, np.int64)[doc], "sequence_id": (cell << 32) + window, "offset": offset,
            "context_size": per_window([s for s, _ in windows]), "step": (cell << 32) + per_window(step)})

    cell = F.pmod(F.xxhash64(id_col, text_col), F.lit(cells)).alias("cell")
    rows = docs.select(cell, id_col, text_col).mapInArrow(
        tokenised, f"cell bigint, `{id_col}` {id_type}, total bigint, sums array<bigint>, tail binary, width int")
    return rows.groupBy("cell").applyInArrow(
        packed, f"`{id_col}` {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                "sequence_id bigint, offset bigint, context_size bigint, step bigint")
