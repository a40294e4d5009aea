"""Language-model scores of whole texts: a log-bilinear model trained by noise-contrastive estimation.

Tokens: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, then one end token (the empty
string, which no word can be). Texts that are null count as empty: one token.

What the corpus gives, counted by Spark over all training texts: every token's count ``c``,
their sum ``N`` and the number of distinct tokens ``V``. The ``vocab`` most frequent tokens
(ties: smaller string) are the model's classes, the rest share one class ``other``.

The model (log-bilinear, Mnih and Hinton 2007; trained as in Mnih and Teh 2012): a token's
context is the ``context`` tokens before it (the end token stands in before a text's
start). Each class has an input vector ``R`` and an output vector ``Q`` and a bias ``b``;
the predicted vector is ``sum_i C_i * R[w_-i]`` (diagonal position weights ``C_i``), a
class scores ``Q[w] . r + b[w]``. Training is noise-contrastive: every position is set
against classes drawn from the unigram distribution that together count as ``noise`` draws, so no
normalisation is needed while fitting. Equal positions of ``HELD`` or so are worked on together,
weighted by their number, at most ``MOST`` at a time; ``TOGETHER`` of these share ``DRAWN`` draws.
Tasks fit their part of the training texts from the same weights and the weights are averaged,
weighted by positions, once an epoch (parameter averaging). Weights and counts both come from all
positions of all training texts.

Scoring is exact: class scores are normalised over all classes, by the sum of exponentials
of each distinct context (:class:`Normalisers`). A token of class ``other`` has
``P(other | context) * (c + 1) / (N_other + V_other + 1)`` (add-one within the class; ``N_other``
and ``V_other`` count training tokens outside the vocabulary). ``score`` is the log10 of the
product over the text's tokens. ``base_score`` is the add-one unigram
``sum log10((c + 1) / (N + V + 1))``.

Cases: null ``doc_id`` is held out (never trained on); repeated rows are scored each; an
empty training set gives ``N = V = 0`` and a model of the end token alone. Columns other
than id and text are carried by nobody and may clash freely.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .textnative import words

END = ""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CHUNK = 4096          # parameters per row when tasks send their weights; contexts per product
ROWS = 256            # contexts whose normalisers are made together
POSITIONS = 65536     # token positions scored together
TEXT_BYTES = 1 << 22  # of texts cut into tokens together
HELD = 1 << 20        # training positions among which equal ones are looked for
MOST = 8              # equal positions worked on as one
TOGETHER = 32         # distinct positions that share their draws of noise
DRAWN = 64            # draws they share
RESOLVED = 1 << 19    # a token with at least one part in so many of all tokens has its count in every scoring task
TABLE = 1 << 23       # contexts, at most, whose normalisers are kept in a table with a place for each


@dataclass(frozen=True)
class Settings:
    vocab: int = 2048
    dim: int = 32
    context: int = 2
    noise: int = 10
    epochs: int = 3
    rate: float = 0.05
    batch: int = 1024
    seed: int = 11


@dataclass
class Model:
    """Classes ``tokens`` (then ``other``), their counts, the weights and the corpus figures."""

    tokens: list[str]
    counts: np.ndarray
    R: np.ndarray
    Q: np.ndarray
    C: np.ndarray
    b: np.ndarray
    n: int
    v: int

    @property
    def n_other(self) -> int:
        return self.n - int(self.counts.sum())

    @property
    def v_other(self) -> int:
        return self.v - len(self.tokens)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.R.ravel(), self.Q.ravel(), self.C.ravel(), self.b])

    def with_flat(self, flat: np.ndarray) -> "Model":
        shapes = [self.R.shape, self.Q.shape, self.C.shape, self.b.shape]
        parts, at = [], 0
        for shape in shapes:
            size = int(np.prod(shape))
            parts.append(flat[at: at + size].reshape(shape).astype(np.float32))
            at += size
        return replace(self, R=parts[0], Q=parts[1], C=parts[2], b=parts[3])

    def unigram(self) -> np.ndarray:
        """Class shares in the training tokens; ``other`` holds the rest (never zero)."""
        mass = np.append(self.counts.astype(np.float64), max(self.n_other, 0)) + 0.5
        return mass / mass.sum()


def sliced(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``TEXT_BYTES`` of text; a larger text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // TEXT_BYTES
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:]):
        if high > low:
            yield batch.slice(low, high - low)


def tokens_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All tokens of the texts one after another, each text's end included, and every text's number of them."""
    # cut at its blanks, a text with one blank more at its end has the empty string behind its words
    ended = pc.binary_join_element_wise(pc.ascii_lower(pc.fill_null(texts, "")), " ", "")
    found = pc.ascii_split_whitespace(pc.ascii_ltrim_whitespace(ended))
    return found.flatten(), found.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def places_in(tokens: pa.Array, listed: pa.Array) -> np.ndarray:
    """Place of every token in the list, -1 if it is not there."""
    return pc.fill_null(pc.index_in(tokens, listed.cast(tokens.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def contexts(ids: np.ndarray, lengths: np.ndarray, width: int, start: int) -> np.ndarray:
    """``width`` previous classes of every position of the texts; ``start`` before each text."""
    padded = np.full(len(ids) + width * len(lengths), start, np.int64)
    at = np.arange(len(ids)) + width * np.repeat(np.arange(1, len(lengths) + 1), lengths)
    padded[at] = ids
    return np.stack([padded[at - 1 - i] for i in range(width)], axis=1)


def context_keys(ctx: np.ndarray, classes: int) -> np.ndarray:
    """One number for each context."""
    keys = np.zeros(len(ctx), np.int64)
    for i in range(ctx.shape[1]):
        keys = keys * classes + ctx[:, i]
    return keys


def distinct_positions(keys: np.ndarray, classes: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, target and number of each distinct position, from keys of context and target."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    seen = np.diff(first, append=len(keys)).astype(np.float32)
    left, target = np.divmod(keys[first], classes)
    ctx = np.empty((len(first), width), np.int64)
    for i in reversed(range(width)):
        left, ctx[:, i] = np.divmod(left, classes)
    return ctx, target, seen


def predicted(model: Model, ctx: np.ndarray) -> np.ndarray:
    return (model.R[ctx] * model.C[None]).sum(axis=1)


class Scratch(dict):
    """Arrays kept from batch to batch by name, so that a task does not ask for fresh memory all the time."""

    def of(self, name: str, shape: tuple[int, ...], kind: type = np.float32) -> np.ndarray:
        size = math.prod(shape)
        if len(self.get(name, ())) < size:
            self[name] = np.empty(size, kind)
        return self[name][:size].reshape(shape)


class Draw:
    """Classes drawn by their shares: ``searchsorted`` of the sums, mostly read from a table of 65,536 steps."""

    STEPS = 1 << 16

    def __init__(self, shares: np.ndarray):
        self.sums, self.last = np.cumsum(shares), len(shares) - 1
        self.table = np.searchsorted(self.sums, np.arange(self.STEPS + 1) / self.STEPS)

    def of(self, chances: np.ndarray) -> np.ndarray:
        """The class of each number from 0 to below 1."""
        flat = chances.ravel()
        step = (flat * self.STEPS).astype(np.int64)
        out = self.table[step]
        several = np.flatnonzero(out != self.table[step + 1])
        out[several] = np.searchsorted(self.sums, flat[several])
        return np.minimum(out, self.last).reshape(chances.shape)


def _sums(classes: np.ndarray, changes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct classes, of ``n``, and the sum of each one's rows of ``changes``."""
    order = np.argsort(classes.astype(np.uint16 if n <= 1 << 16 else np.int64), kind="stable")
    found = classes[order]
    first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
    return found[first], np.add.reduceat(np.take(changes, order, axis=0), first, axis=0)


def nce_step(model: Model, ctx: np.ndarray, target: np.ndarray, noise: np.ndarray, log_kpn: np.ndarray,
             rate: float, scratch: Scratch | None = None, seen: np.ndarray | None = None, share: float = 1.0,
             often: tuple[np.ndarray | None, np.ndarray | None] = (None, None)) -> None:
    """One step of noise-contrastive estimation on a batch of positions, in place.

    A position stands for ``seen`` equal ones. As many positions one after another as there are for
    each row of ``noise`` are set against the classes in it, each of which counts as ``share`` draws.
    A class moves by its mean change over the batch: one seen often as far as one seen once. If
    ``often`` is given, how often it is expected there as target or noise and in contexts counts instead.
    """
    scratch = Scratch() if scratch is None else scratch
    (n, width), dim, (groups, drawn) = ctx.shape, model.Q.shape[1], noise.shape
    seen = np.ones(n, np.float32) if seen is None else seen
    rc = np.take(model.R, ctx, axis=0, out=scratch.of("rc", (n, width, dim)), mode="clip")
    r = np.einsum("nwd,wd->nd", rc, model.C)
    grouped = r.reshape(groups, n // groups, dim)

    def slope(score: np.ndarray, offset: np.ndarray) -> np.ndarray:
        """Model's share of the odds against noise."""
        score -= offset
        np.clip(score, -30, 30, out=score)
        np.exp(np.negative(score, out=score), out=score)
        score += 1.0
        return np.divide(1.0, score, out=score)

    offsets = (log_kpn - model.b).astype(np.float32)
    q_target = np.take(model.Q, target, axis=0, out=scratch.of("qt", (n, dim)), mode="clip")
    q_noise = model.Q[noise]
    g_target = (slope(np.einsum("nd,nd->n", r, q_target), offsets[target]) - 1.0) * (rate * seen)   # d loss / d score
    g_noise = slope(np.matmul(grouped, q_noise.transpose(0, 2, 1)), offsets[noise][:, None, :])
    g_noise *= (rate * share * seen).reshape(groups, -1, 1)
    grad_r = np.matmul(g_noise, q_noise).reshape(n, dim)
    q_target *= g_target[:, None]
    grad_r += q_target

    def moved(classes: np.ndarray, changes: np.ndarray, often: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The classes met and the mean change of each; the last column is the weight."""
        hit, total = _sums(classes, changes, len(model.b))
        return hit, total[:, :-1] / (total[:, -1] if often is None else often[hit])[:, None]

    changes = scratch.of("changes", (n + groups * drawn, dim + 2))   # of the vector, of the bias, weight
    np.multiply(r, g_target[:, None], out=changes[:n, :dim])
    changes[:n, dim], changes[:n, dim + 1] = g_target, seen
    changes[n:, :dim] = np.matmul(g_noise.transpose(0, 2, 1), grouped).reshape(-1, dim)
    changes[n:, dim] = g_noise.sum(axis=1).ravel()
    changes[n:, dim + 1] = np.repeat(share * seen.reshape(groups, -1).sum(axis=1), drawn)
    hit, change = moved(np.concatenate([target, noise.ravel()]), changes, often[0])
    back = scratch.of("back", (width, n, dim + 1))
    np.multiply(grad_r, model.C[:, None], out=back[:, :, :dim])
    back[:, :, dim] = seen
    hit_r, change_r = moved(ctx.T.ravel(), back.reshape(-1, dim + 1), often[1])
    model.Q[hit] -= change[:, :dim]
    model.b[hit] -= change[:, dim]
    model.R[hit_r] -= change_r
    model.C -= np.einsum("nd,nwd->wd", grad_r, rc) / seen.sum()


def log_probabilities(model: Model, ctx: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log P(class | context) of each position, normalised over all classes."""
    out = np.empty(len(target), np.float64)
    for at in range(0, len(target), CHUNK):
        r = predicted(model, ctx[at: at + CHUNK])
        logits = r @ model.Q.T + model.b
        top = logits.max(axis=1, keepdims=True)
        lse = top[:, 0].astype(np.float64) + np.log(np.exp(logits - top).sum(axis=1, dtype=np.float64))
        out[at: at + CHUNK] = logits[np.arange(len(r)), target[at: at + CHUNK]] - lse
    return out


def fit_positions(model: Model, keys: np.ndarray, s: Settings, draw: Draw, log_kpn: np.ndarray,
                  rng: np.random.Generator, scratch: Scratch) -> None:
    """Steps over the positions of ``keys`` in random order, ``batch`` of them a step on average, in place."""
    ctx, target, seen = distinct_positions(keys, len(model.b), s.context)
    parts = np.ceil(seen / MOST).astype(np.int64)
    order = rng.permutation(np.repeat(np.arange(len(seen)), parts))
    seen /= parts
    p = (model.unigram() * s.batch).astype(np.float32)
    often = np.maximum(p * (1 + s.noise), 1.0), np.maximum(p * s.context, 1.0)
    rows = max(1, round(s.batch * len(order) / (len(keys) * TOGETHER))) * TOGETHER
    for at in range(0, len(order), rows):
        pick = order[at: at + rows]
        groups = -(-len(pick) // TOGETHER)
        fill = groups * TOGETHER - len(pick)      # the last one again, without weight
        pick = np.concatenate([pick, np.repeat(pick[-1:], fill)])
        weight = seen[pick]
        weight[len(pick) - fill:] = 0
        nce_step(model, ctx[pick], target[pick], draw.of(rng.random((groups, DRAWN))), log_kpn, s.rate, scratch,
                 weight, s.noise / DRAWN, often)


def _fitter(model: Model, s: Settings):
    """Per task: train a copy of the weights on the task's texts; send them, weighted, in chunks."""
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = model.with_flat(model.flat())
        other, start = len(local.tokens), index_of_end(local)
        listed, p = pa.array(local.tokens, pa.string()), local.unigram()
        draw, log_kpn, scratch = Draw(p), np.log(s.noise * p).astype(np.float32), Scratch()
        rng = np.random.default_rng(s.seed * 7919 + (TaskContext.get().partitionId() if TaskContext.get() else 0))
        seen, held, parts = 0, 0, []
        for batch in batches:
            for rows in sliced(batch):
                tokens, lengths = tokens_in(rows.column("text"))
                ids = places_in(tokens, listed)
                ids[ids < 0] = other
                parts.append(context_keys(contexts(ids, lengths, s.context, start), other + 1) * (other + 1) + ids)
                seen += len(ids)
                held += len(ids)
                if held >= HELD:
                    fit_positions(local, np.concatenate(parts), s, draw, log_kpn, rng, scratch)
                    held, parts = 0, []
        if parts:
            fit_positions(local, np.concatenate(parts), s, draw, log_kpn, rng, scratch)
        if seen:
            flat = local.flat().astype(np.float64) * seen
            rows = [(i // CHUNK, float(seen), flat[i: i + CHUNK].tolist()) for i in range(0, len(flat), CHUNK)]
            yield pa.RecordBatch.from_pylist([dict(zip(("chunk", "weight", "values"), r)) for r in rows],
                                             schema=_SENT)
    return fit


_SENT = pa.schema([("chunk", pa.int64()), ("weight", pa.float64()), ("values", pa.list_(pa.float64()))])


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    """Element-wise sum of one chunk's weights over all tasks."""
    values = np.sum(np.stack(rows["values"].to_numpy()), axis=0)
    return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "weight": [rows["weight"].sum()],
                         "values": [values.tolist()]})


def index_of_end(model: Model) -> int:
    return model.tokens.index(END) if END in model.tokens else len(model.tokens)


def tokens_of(text: Column) -> Column:
    """The same tokens on the JVM: lower-cased A-Z words, then the end token."""
    return F.array_append(words(F.translate(text, UPPER, LOWER)), F.lit(END))


def train(spark: SparkSession, training: DataFrame, s: Settings = Settings(), text_col: str = "text",
          id_col: str = "doc_id") -> tuple[Model, DataFrame]:
    """The model and the table of all token counts ``(token, c)`` of ``training``."""
    path = work_path(spark, "lm-counts")
    training.select(F.explode(tokens_of(F.col(f"`{text_col}`"))).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("c")).write.parquet(path)
    counts = spark.read.parquet(path)
    n, v = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    n, v = int(n or 0), int(v or 0)
    top = counts.orderBy(F.desc("c"), "token").limit(s.vocab).collect()       # bounded by s.vocab
    tokens, c = [r.token for r in top], np.array([r.c for r in top], np.int64)
    rng = np.random.default_rng(s.seed)
    k = len(tokens) + 1
    if k ** (s.context + 1) >= 1 << 63:
        raise ValueError("vocab and context are too large for one number for each context and token")
    model = Model(tokens, c, (rng.standard_normal((k, s.dim)) * 0.1).astype(np.float32),
                  (rng.standard_normal((k, s.dim)) * 0.1).astype(np.float32),
                  np.full((s.context, s.dim), 1.0 / s.context, np.float32), np.zeros(k, np.float32), n, v)
    model.b = np.log(model.unigram()).astype(np.float32)
    texts = training.select(F.col(f"`{text_col}`").alias("text"))
    for _ in range(s.epochs if n else 0):
        sent = texts.mapInArrow(_fitter(model, s), "chunk long, weight double, values array<double>").groupBy("chunk").applyInPandas(
            _summed, "chunk long, weight double, values array<double>").collect()   # bounded by the weights
        if not sent:
            break
        ordered = sorted(sent, key=lambda r: r["chunk"])
        flat = np.concatenate([np.asarray(r["values"], np.float64) for r in ordered])
        model = model.with_flat(flat / float(ordered[0]["weight"]))
    return model, counts


_SCORED = ("n_tokens long, n_vocab long, base_vocab double, model_part double, "
           "oov array<struct<token:string,m:long>>")


class Normalisers:
    """``log sum exp`` of all class scores per context, computed once per distinct context in a task.

    The normaliser depends on the context alone, and frequent contexts recur in every
    batch; a bounded table keeps them from batch to batch. A class's score is a sum with
    one term for each place of the context, so its exponential is a product: each place
    has a table of exponentials by context class and scored class, and a context needs
    one product of their rows. Terms are scaled by the largest of their row; should a
    sum leave the range of numbers all the same, it is made from the scores themselves.
    """

    def __init__(self, model: Model, limit: int = 2_000_000):
        self.model, self.limit, self.known, self.all = model, limit, {}, None
        self.bias, self.tables, self.tops = np.exp(model.b - model.b.max()), [], []
        for weights in model.C:
            terms = (model.R * weights) @ model.Q.T
            self.tops.append(terms.max(axis=1))
            terms -= self.tops[-1][:, None]
            self.tables.append(np.exp(terms, out=terms))

    def made(self, rows: np.ndarray) -> np.ndarray:
        """Normalisers of ``rows``, one context each, in order; those that differ in the last class only go together."""
        total = np.empty(len(rows), np.float32)
        new = np.flatnonzero((rows[1:, :-1] != rows[:-1, :-1]).any(axis=1)) + 1
        for low, high in zip([0, *new.tolist()], [*new.tolist(), len(rows)], strict=True):
            left = self.bias
            for table, c in zip(self.tables, rows[low, :-1].tolist()):
                left = left * table[c]
            for at in range(low, high, ROWS):
                end = min(at + ROWS, high)
                total[at:end] = self.tables[-1][rows[at:end, -1]] @ left
        safe = total > 1e-25
        out = np.log(np.where(safe, total, 1), dtype=np.float64) + float(self.model.b.max())
        out += sum(top[rows[:, i]].astype(np.float64) for i, top in enumerate(self.tops))
        if not safe.all():
            logits = (predicted(self.model, rows[~safe]) @ self.model.Q.T + self.model.b).astype(np.float64)
            top = logits.max(axis=1)
            out[~safe] = top + np.log(np.exp(logits - top[:, None]).sum(axis=1))
        return out

    def of(self, ctx: np.ndarray) -> np.ndarray:
        width = len(self.model.tokens) + 1
        keys = context_keys(ctx, width)
        if width ** ctx.shape[1] <= TABLE:
            if self.all is None:
                self.all = np.full(width ** ctx.shape[1], np.nan)
            new = np.flatnonzero(np.isnan(self.all[keys]))
            if len(new):
                unique, first = np.unique(keys[new], return_index=True)
                self.all[unique] = self.made(ctx[new[first]])
            return self.all[keys]
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) > self.limit:
            self.known.clear()
        missing = np.array([k not in self.known for k in unique.tolist()], bool)
        if missing.any():
            self.known.update(zip(unique[missing].tolist(), self.made(ctx[first[missing]]).tolist()))
        return np.array([self.known[k] for k in unique.tolist()])[inverse.ravel()]


def target_log_probabilities(model: Model, ctx: np.ndarray, target: np.ndarray, norm: Normalisers) -> np.ndarray:
    """Natural log P(class | context) per position: its score less its context's normaliser."""
    r = predicted(model, ctx)
    score = np.einsum("nd,nd->n", r, model.Q[target]) + model.b[target]
    return score.astype(np.float64) - norm.of(ctx)


def _scorer(model: Model, s: Settings, carried: list[str], frequent: list[tuple[str, int]] = ()):
    """Scores of texts; the counts of ``frequent`` tokens outside the vocabulary are looked up here, the rest is listed."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        other, start = len(model.tokens), index_of_end(model)
        listed = pa.array([*model.tokens, *(t for t, _ in frequent)], pa.string())
        # the last place is that of tokens not listed, which get their part by the join
        counts = np.array([*model.counts.tolist(), *(c for _, c in frequent), 0]) + 1.0
        base = np.log10(counts / (model.n + model.v + 1))
        inner = np.log10(counts / _rest(model))
        base[-1] = inner[-1] = 0.0
        inner[:other] = 0.0
        norm = Normalisers(model)
        context = TaskContext.get()
        next_key = [(context.partitionId() if context else 0) << 33]

        def figures(rows: pa.RecordBatch) -> pa.RecordBatch:
            tokens, lengths = tokens_in(rows.column("text"))
            at = np.cumsum(lengths) - lengths
            places = places_in(tokens, listed)
            target = np.where((places < 0) | (places > other), other, places)
            ctx = contexts(target, lengths, s.context, start)
            logp = inner[places]
            for low in range(0, len(target), POSITIONS):    # memory stays bounded whatever a text holds
                part = slice(low, low + POSITIONS)
                logp[part] += target_log_probabilities(model, ctx[part], target[part], norm) / math.log(10)
            done = pa.RecordBatch.from_arrays([
                pa.array(lengths), pa.array(np.add.reduceat((places >= 0).astype(np.int64), at)),
                pa.array(np.add.reduceat(base[places], at)), pa.array(np.add.reduceat(logp, at)),
                _counted(tokens, places < 0, lengths)], schema=_SCORED_ARROW)
            keys = pa.array(np.arange(next_key[0], next_key[0] + rows.num_rows, dtype=np.int64))
            next_key[0] += rows.num_rows
            return pa.RecordBatch.from_arrays([keys] + [rows.column(c) for c in carried] + done.columns,
                                              names=["doc_key"] + carried + done.schema.names)

        for batch in batches:
            for rows in sliced(batch):
                yield figures(rows)
    return score


def _rest(model: Model) -> int:
    """What the counts outside the vocabulary are divided by."""
    return max(model.n_other, 0) + max(model.v_other, 0) + 1


def _counted(tokens: pa.Array, lost: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Per text, its tokens marked ``lost`` with their counts, as one Arrow list array."""
    coded = tokens.filter(pa.array(lost)).dictionary_encode()
    names, codes = coded.dictionary.cast(pa.string()), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    texts = np.repeat(np.arange(len(lengths)), lengths)[lost]
    found, m = np.unique(texts * max(len(names), 1) + codes, return_counts=True)
    texts, codes = np.divmod(found, max(len(names), 1))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(texts, minlength=len(lengths)))])
    items = pa.StructArray.from_arrays([names.take(pa.array(codes)), pa.array(m.astype(np.int64))], ["token", "m"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)


_SCORED_ARROW = pa.schema([
    ("n_tokens", pa.int64()), ("n_vocab", pa.int64()), ("base_vocab", pa.float64()),
    ("model_part", pa.float64()), ("oov", pa.list_(pa.struct([("token", pa.string()), ("m", pa.int64())])))])


def score(spark: SparkSession, docs: DataFrame, held_out: Column, s: Settings = Settings(),
          text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``."""
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held_out.alias("held_out"),
                        F.col(f"`{text_col}`").alias("text"))
    model, counts = train(spark, plain.where(~F.col("held_out")), s, "text", "doc_id")
    return apply(spark, plain, model, counts, s)


def apply(spark: SparkSession, docs: DataFrame, model: Model, counts: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Scores of ``docs`` (doc_id, held_out, text) under ``model`` and the token ``counts``.

    Each row gets a key inside its scoring task (task's partition, row within it), and the
    scores are stored before anything else reads them, so the key holds for all that follows.
    Every task has the counts of tokens with at least one part in ``RESOLVED`` of all tokens, so
    at most that many; only others are joined with the table of counts.
    """
    listed = set(model.tokens)
    often = counts.where(F.col("c") >= model.n / RESOLVED).collect()   # at most RESOLVED rows
    frequent = [(r.token, r.c) for r in often if r.token not in listed]
    scored_path = work_path(spark, "lm-scored")
    carried = ["doc_id", "held_out"]
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in carried)
    docs.select(*carried, "text").mapInArrow(_scorer(model, s, carried, frequent), f"doc_key long, {schema}, {_SCORED}").write.parquet(
        scored_path)
    scored = spark.read.parquet(scored_path)

    whole = math.log10(model.n + model.v + 1)
    rest = math.log10(_rest(model))
    outside = scored.select("doc_key", F.explode("oov").alias("o")).select("doc_key", "o.token", "o.m").join(
        counts, "token", "left").select(
        "doc_key", F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        F.lit(None).cast("boolean").alias("held_out"), F.lit(0).cast("bigint").alias("n_tokens"),
        (F.col("m") * (F.coalesce("c", F.lit(0)) > 0).cast("bigint")).alias("known"),
        (F.col("m") * (F.log10(F.coalesce("c", F.lit(0)) + 1) - whole)).alias("base"),
        (F.col("m") * (F.log10(F.coalesce("c", F.lit(0)) + 1) - rest)).alias("model"))
    inside = scored.select(
        "doc_key", "doc_id", "held_out", "n_tokens", F.col("n_vocab").alias("known"),
        F.col("base_vocab").alias("base"), F.col("model_part").alias("model"))
    total = inside.unionByName(outside).groupBy("doc_key").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("model").alias("score"))
    return total.select("doc_id", "held_out", F.col("n_tokens").cast("bigint"), F.col("n_known").cast("bigint"),
                        F.lit(model.n).cast("bigint").alias("train_tokens"), "base_score", "score")
