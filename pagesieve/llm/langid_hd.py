"""Language identification with hyperdimensional letter profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A
trigram is bound by multiplying the vectors of its letters, each permuted
(rotated) by its place; a text is bundled by adding its trigrams' vectors; a
language's prototype is the bundle of all its training texts. A text is given
the language whose prototype has the largest cosine with its own bundle
(Joshi, Halseth and Kanerva 2016).

Binding and bundling are linear in trigram counts, so a chunk of texts is one
matrix product: counts by text and trigram, times trigram vectors. A text longer
than a chunk is bundled in pieces that overlap by two signs, with one sum.

Training adds bundles within a task; one row per task, language and dimension is
summed by Spark. What reaches the driver is one vector per language.

Cases: null text, or text without a letter -> ``und``, score 0. Null language or
null id: not learned from. No training rows: every text is ``und``. Repeated rows
count as often as they occur in training and get equal predictions. Two
languages with equal cosine: the first by name. Columns besides id and text are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
CHUNK_SIGNS = 400_000
CHUNK_TEXTS = 256
GRAM_BLOCK = 8192
UNKNOWN = "und"
_BLANK = 0x20


class Bundler:
    """Turns texts into bundles; one per task."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 1):
        self.dimensions, self.seed = dimensions, seed
        self._vectors: dict[int, np.ndarray] = {}
        self._is_letter = np.fromiter(
            (chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self._vectors:
            if len(self._vectors) > 20_000:
                self._vectors.clear()
            draw = np.random.Generator(np.random.Philox(key=[self.seed, code]))
            self._vectors[code] = draw.integers(0, 2, self.dimensions, np.int8) * np.int8(2) - np.int8(1)
        return self._vectors[code]

    def signs(self, text: str | None) -> np.ndarray:
        """Code points in lower case, one blank around every run of letters; empty if there is no letter."""
        if not text:
            return np.zeros(0, np.uint32)
        codes = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
        letter = self._is_letter[codes]
        if not letter.any():
            return np.zeros(0, np.uint32)
        codes = np.concatenate(([_BLANK], np.where(letter, codes, _BLANK), [_BLANK])).astype(np.uint32)
        blank = codes == _BLANK
        return codes[~(blank & np.concatenate(([False], blank[:-1])))]

    def chunks(self, texts: list[str | None]) -> Iterator[list[tuple[int, np.ndarray]]]:
        """``(text number, signs)`` in lists of bounded size."""
        chunk, size = [], 0
        for i, text in enumerate(texts):
            signs = self.signs(text)
            for start in range(0, max(len(signs) - 2, 0), CHUNK_SIGNS):
                piece = signs[start: start + CHUNK_SIGNS + 2]
                if chunk and (size + len(piece) > CHUNK_SIGNS + 2 or len(chunk) == CHUNK_TEXTS):
                    yield chunk
                    chunk, size = [], 0
                chunk.append((i, piece))
                size += len(piece)
        if chunk:
            yield chunk

    def bundle(self, pieces: list[np.ndarray], groups: np.ndarray, n_groups: int) -> np.ndarray:
        """Sum of trigram vectors per group; ``groups`` has one number per piece."""
        signs = np.concatenate(pieces)
        owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        alphabet = np.flatnonzero(np.bincount(signs))
        small = np.zeros(int(alphabet[-1]) + 1, np.int64)
        small[alphabet] = np.arange(len(alphabet))
        s, a = small[signs], len(alphabet)
        grams = ((s[:-2] * a + s[1:-1]) * a + s[2:])[owner[:-2] == owner[2:]]
        owner = np.asarray(groups)[owner[:-2][owner[:-2] == owner[2:]]]
        if a ** 3 <= 4_000_000:
            known = np.flatnonzero(np.bincount(grams, minlength=1))
            place = np.zeros(int(known[-1]) + 1, np.int64)
            place[known] = np.arange(len(known))
            place = place[grams]
        else:
            known, place = np.unique(grams, return_inverse=True)
        letters = np.stack([self._letter(int(c)) for c in alphabet])
        first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
        out = np.zeros((n_groups, self.dimensions), np.float32)
        for start in range(0, len(known), GRAM_BLOCK):
            block = known[start: start + GRAM_BLOCK]
            bound = first[block // (a * a)] * second[block // a % a] * letters[block % a]
            here = slice(None) if len(known) <= GRAM_BLOCK else (place >= start) & (place < start + GRAM_BLOCK)
            counts = np.bincount(owner[here] * len(block) + place[here] - start, minlength=n_groups * len(block))
            out += counts.reshape(n_groups, -1).astype(np.float32) @ bound.astype(np.float32)
        return out


def train_prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     dimensions: int = DIMENSIONS, seed: int = 1) -> dict[str, np.ndarray]:
    """Language -> unit vector. ``docs`` are the rows to learn from."""

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler, sums = Bundler(dimensions, seed), {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for chunk in bundler.chunks(batch.column(0).to_pylist()):
                names = sorted({langs[i] for i, _ in chunk})
                number = {name: k for k, name in enumerate(names)}
                made = bundler.bundle([p for _, p in chunk],
                                      np.array([number[langs[i]] for i, _ in chunk]), len(names))
                for name, vector in zip(names, made, strict=True):
                    sums[name] = sums.get(name, 0) + np.rint(vector).astype(np.int64)
        for name in sorted(sums):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)),
                 pa.array(sums[name])], names=["lang", "dim", "value"])

    rows = (
        docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(text_col), F.col(lang_col))
        .mapInArrow(bundles, "lang string, dim int, value bigint")
        .groupBy("lang", "dim").agg(F.sum("value").alias("value"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "value"))).alias("v"))
        .select("lang", F.col("v.value").alias("v")).collect()  # one row per language
    )
    found = {}
    for row in sorted(rows):
        vector = np.array(row["v"], np.float64)
        if (length := np.sqrt((vector ** 2).sum())) > 0:
            found[row["lang"]] = (vector / length).astype(np.float32)
    return found


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id",
            text_col: str = "text", dimensions: int = DIMENSIONS, seed: int = 1) -> DataFrame:
    """``id_col, lang_pred, score`` for every row of ``docs``; score is the cosine, at least 0."""
    names = sorted(prototypes)
    table = np.stack([prototypes[n] for n in names], axis=1) if names else None
    id_type = docs.schema[id_col].dataType.simpleString()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler = Bundler(dimensions, seed)
        for batch in batches:
            n = batch.num_rows
            best, score, carried = np.full(n, -1), np.zeros(n), None

            def settle(rows: np.ndarray, vectors: np.ndarray) -> None:
                length = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
                cosine = (vectors @ table) / np.maximum(length, 1e-9)[:, None]
                best[rows] = cosine.argmax(axis=1)  # noqa: B023
                score[rows] = np.clip(cosine.max(axis=1), 0.0, 1.0)  # noqa: B023

            for chunk in bundler.chunks(batch.column(1).to_pylist()) if names else ():
                rows, groups = np.unique([i for i, _ in chunk], return_inverse=True)
                made = bundler.bundle([p for _, p in chunk], groups, len(rows))
                if carried is not None and carried[0] == rows[0]:  # the text's earlier pieces
                    made[0] += carried[1]
                carried = (rows[-1], made[-1])
                settle(rows, made)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([names[b] if b >= 0 else UNKNOWN for b in best]),
                 pa.array(score)], names=[id_col, "lang_pred", "score"])

    return docs.select(id_col, text_col).mapInArrow(
        label, f"`{id_col}` {id_type}, lang_pred string, score double")


def held_out(id_col: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    """Whether a row is kept from training: crc32 of its id as text, by remainder. A null id is."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % parts
    return F.coalesce(rest == part, F.lit(True))
