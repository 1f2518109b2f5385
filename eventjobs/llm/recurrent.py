"""Log-likelihood of whole documents by a gated recurrent language model.

Tokens are a text's words, A-Z lower-cased, and one end. Words are counted over all training documents. The most
frequent ones are the model's vocabulary; all others are one symbol to it, and what such a word is follows from its
count among its like, so every text has a probability. The model is a gated recurrent unit in numpy. Its softmax is
factored by classes of words of similar frequency: first the class, then the word in its class. It is trained by
truncated backpropagation: a bounded sample of documents gives it a beginning, from which every task then learns from
all its training documents by itself; the tasks' models, weighted by their tokens, are averaged. For scoring, a
document's state begins at zero and is carried from window to window to its end, so texts of any length are scored whole
and a window bounds what is held.

Counts that are not among the most frequent (`table` of them go to all tasks, a bounded size) are joined, one row
for each document and such word. Words of more than LONGEST bytes are known by a digest.

Defined cases. A null or empty text is the end alone. A null doc_id is of the training part and not held out; rows that
repeat a doc_id are scored each. Equal texts have equal scores but for rounding. Without training documents counts are
0 and the model is that before training. Very long texts are used whole. An empty table gives no rows; further columns
are not looked at.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial
from itertools import repeat
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import release, text_passes, written

#: Bytes of a word that stands for itself; of a task's distinct words held before they are handed on.
LONGEST, HELD, HELD_BYTES = 40, 400_000, 1 << 28
#: How a symbol is kept; a vocabulary has no more.
SYMBOL = np.dtype(np.uint16)
#: The model's symbols before words: any word beyond the vocabulary, and a document's end (also its beginning).
RARE, END = 0, 1
#: Tokens of an output pass, and of a part of it whose shares of classes a processor's cache holds; documents whose states it holds; numbers of a row of weights; parts in which tasks' weights are first summed.
PASS, CACHED, TOGETHER, CHUNK, PARTS = 1 << 14, 1 << 11, 1 << 10, 1 << 16, 64


@dataclass(frozen=True)
class Params:
    """vocabulary: symbols of the model. classes: of the factored softmax. state: numbers of it. window: tokens of truncated backpropagation. table: counts that go to all tasks. warm: about how many training documents are in the sample of the beginning (twice as many at most), and epochs over it."""

    vocabulary: int = 2048
    classes: int = 40
    state: int = 16
    window: int = 32
    lanes: int = 768
    table: int = 1 << 16
    warm: int = 1500
    epochs: int = 2
    rate: float = 0.06
    later: float = 0.02
    seed: int = 13


def key_of(word: bytes) -> bytes:
    """The word, or, with a blank that no word holds, its digest."""
    return word if len(word) <= LONGEST else b" " + hashlib.md5(word).digest()


def words_of(text: bytes) -> list[bytes]:
    """The words between blanks and the bytes 9 to 13, A-Z in small letters, as bytes.split and bytes.lower have them."""
    return text.lower().split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word (key), n of a task's texts, a few hundred thousand words or some hundred megabytes of text at a time."""
    held: Counter[bytes] = Counter()
    batch_of = lambda: pa.RecordBatch.from_arrays([pa.array(map(key_of, held), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"])
    read = 0
    for batch in batches:
        for _, _, texts in text_passes(batch.column(0)):
            for text in texts:
                held.update(words_of(text))
                read += len(text)
            if len(held) >= HELD or read >= HELD_BYTES:
                yield batch_of()
                held.clear()
                read = 0
    yield batch_of()


@dataclass
class Counts:
    """Facts over all training tokens: tokens and distinct ones, ends, the most frequent words by count; what lies beyond the model's vocabulary."""

    tokens: int
    distinct: int
    ends: int
    words: list[bytes]
    counts: np.ndarray
    symbols: int  # of the model: RARE, END and the first words
    rare_tokens: int
    rare_distinct: int

    def lookup(self) -> dict[bytes, int]:
        return {w: k for k, w in enumerate(self.words)}

    @property
    def floor(self) -> float:
        """log10 of what a count is divided by."""
        return float(np.log10(self.tokens + 0.5 * (self.distinct + 1)))

    @property
    def rare_floor(self) -> float:
        return float(np.log10(self.rare_tokens + 0.5 * (self.rare_distinct + 1)))

    def symbol_counts(self) -> np.ndarray:
        return np.concatenate([[self.rare_tokens, self.ends], self.counts[: self.symbols - 2]]).astype(float)


def most_frequent(table: DataFrame, most: int) -> Column:
    """Which words are among about so many most frequent ones, not more. The driver gets two histograms of bounded size, not every task's first words.

    Words are taken by steps of their count, and of the step that does not fit whole by steps of a hash."""
    step, part = F.floor(F.log2("n") * 16).cast("int"), F.pmod(F.xxhash64("word"), F.lit(1 << 14)).cast("int")
    left, lowest = most, 1 << 30
    for k, n in sorted(((r[0], r[1]) for r in table.groupBy(step).agg(F.count("*")).collect()), reverse=True):
        if n > left:
            last = 0
            for h, m in sorted((r[0], r[1]) for r in table.where(step == k).groupBy(part).agg(F.count("*")).collect()):
                if m > left:
                    break
                left, last = left - m, h + 1
            return (step >= lowest) | ((step == k) & (part < last))
        left, lowest = left - n, k
    return step >= lowest


def count(train: DataFrame, p: Params) -> tuple[Counts, DataFrame]:
    """The counts of train (text), and all of them as a written table (word, n)."""
    table = written(train.mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    said, kinds = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = train.count()
    top = table.where(most_frequent(table, p.table)).toPandas().sort_values(["n", "word"], ascending=[False, True])
    words, counts = [bytes(w) for w in top["word"]], top["n"].to_numpy(dtype=np.int64)
    known = min(p.vocabulary - 2, len(words), (1 << 16) - 2)
    return Counts(said + ends, kinds + (ends > 0), ends, words, counts, known + 2, int(said - counts[:known].sum()), kinds - known), table


class Model:
    """Weights of the recurrent unit and of the factored softmax."""

    NAMES = ("inputs", "recurrent", "classes", "class_bias", "words", "word_bias")

    def __init__(self, counts: Counts, p: Params):
        v, h, rng = counts.symbols, p.state, np.random.default_rng(p.seed)
        often = counts.symbol_counts() + 0.5
        self.starts = class_starts(often, p.classes)
        self.class_of = np.searchsorted(self.starts, np.arange(v), side="right") - 1
        mass = np.add.reduceat(often, self.starts)
        self.inputs = rng.normal(0, 0.2, (v, 3 * h)).astype(np.float32)
        self.recurrent = rng.normal(0, 1 / np.sqrt(h), (h, 3 * h)).astype(np.float32)
        self.classes, self.class_bias = np.zeros((self.starts.size, h), np.float32), np.log(mass / mass.sum()).astype(np.float32)
        self.words, self.word_bias = np.zeros((v, h), np.float32), np.log(often / mass[self.class_of]).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size


def class_starts(often: np.ndarray, classes: int) -> np.ndarray:
    """Where classes of symbols begin: RARE by itself, then ranges of equal sums of square roots of counts, so frequent words are in small ones."""
    share = np.cumsum(np.sqrt(often[1:]))
    at = np.searchsorted(share, np.arange(classes - 1) * share[-1] / max(1, classes - 1), side="right") + 1
    return np.unique(np.concatenate([[0, 1], at[at < often.size]]))


def sigmoid(x: np.ndarray) -> None:
    """Of all numbers of x, in their place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5


def logits(weights: np.ndarray, bias: np.ndarray, states: np.ndarray) -> np.ndarray:
    """A row for each weight, a column for each state."""
    return weights @ states.T + bias[:, None]


def shares(weights: np.ndarray, bias: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp of logits by a factor of each column, and the sums of columns; what the factor is does not matter to a share.

    One factor for all columns does, where no column lies so far below the largest number that it vanishes."""
    e = weights @ states.T
    if e.size:
        e += (bias - bias.max() - e.max())[:, None]
    np.exp(e, out=e)
    sums = np.ones(e.shape[0], e.dtype) @ e
    low = np.flatnonzero(sums < 1e-25)
    if low.size:
        x = logits(weights, bias, states[low])
        e[:, low] = x = np.exp(x - x.max(axis=0))
        sums[low] = x.sum(axis=0)
    return e, sums


def log_of(weights: np.ndarray, bias: np.ndarray, states: np.ndarray, e: np.ndarray, sums: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The logarithm of each column's share at one place; from the logits themselves where the share has vanished."""
    own = e[at, np.arange(at.size)]
    out = np.log(np.maximum(own, 1e-37) / sums)
    low = np.flatnonzero(own < 1e-30)
    if low.size:
        x = logits(weights, bias, states[low])
        most = x.max(axis=0)
        out[low] = x[at[low], np.arange(low.size)] - most - np.log(np.exp(x - most).sum(axis=0))
    return out


def sorted_runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys (16 bits do), and where in it runs of equal ones begin."""
    order = np.argsort(keys.astype(SYMBOL), kind="stable")
    held = keys[order]
    return order, np.flatnonzero(np.append(True, held[1:] != held[:-1])[: held.size])


def by_class(m: Model, symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
    """The order of symbols by class; first and last symbol (exclusive) of each class that holds several, and from where to where it goes in that order."""
    of = m.class_of[symbols]
    order, at = sorted_runs(of)
    ends = np.append(m.starts[1:], m.class_of.size)
    runs = zip(of[order[at]].tolist(), at.tolist(), [*at[1:].tolist(), order.size], strict=True)
    return order, [(int(m.starts[c]), int(ends[c]), a, b) for c, a, b in runs if ends[c] - m.starts[c] > 1]


def log_probabilities(m: Model, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    states = np.ascontiguousarray(states)
    of, out = m.class_of[symbols], np.zeros(symbols.size)
    for a in range(0, of.size, CACHED):
        of_class = (m.classes, m.class_bias, states[a : a + CACHED])
        out[a : a + CACHED] = log_of(*of_class, *shares(*of_class), of[a : a + CACHED])
    order, runs = by_class(m, symbols)
    states, symbols, inner = states[order], symbols[order], np.zeros(order.size)
    for lo, hi, a, b in runs:
        of_words = (m.words[lo:hi], m.word_bias[lo:hi], states[a:b])
        inner[a:b] = log_of(*of_words, *shares(*of_words), symbols[a:b] - lo)
    out[order] += inner
    return out


def stepped(m: Model, state: np.ndarray, given: np.ndarray) -> tuple[np.ndarray, ...]:
    """The state (a column for each text) after symbols, and what backpropagation needs: r, z, n and the recurrent part of n.

    given: the columns of inputs of the symbols, in whose place the last three are made. With numbers of one kind in whole rows numpy goes
    through a row at a time; a row for each text would be gone through by the few numbers of a state."""
    h = state.shape[0]
    own = m.recurrent.T @ state
    gates, n, part = given[: 2 * h], given[2 * h :], own[2 * h :]
    gates += own[: 2 * h]
    sigmoid(gates)
    r, z = gates[:h], gates[h:]
    n += r * part
    np.tanh(n, out=n)
    new = state - n
    new *= z
    new += n
    return new, r, z, n, part


def likelihoods(m: Model, symbols: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Of each document (symbols from at[k] to at[k + 1], the end included) the natural logarithm of its probability."""
    sizes = np.diff(at)
    order = np.argsort(-sizes, kind="stable")
    inputs = np.ascontiguousarray(m.inputs.T)
    out = np.zeros(order.size)
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def settle() -> None:
        states, wanted, lanes = (np.concatenate(x, axis=-1) for x in zip(*waiting, strict=True))
        waiting.clear()
        for a in range(0, wanted.size, PASS):
            found = log_probabilities(m, states[:, a : a + PASS].T, wanted[a : a + PASS])
            np.add.at(out, lanes[a : a + PASS], found)

    held = 0
    for first in range(0, order.size, TOGETHER):
        some = order[first : first + TOGETHER]
        begin, left, last = at[:-1][some], -sizes[some], np.full(some.size, END)
        state = np.zeros((m.recurrent.shape[0], some.size), np.float32)
        for t in range(-int(left[0])):
            active = int(np.searchsorted(left, -t, side="left"))  # documents of more than t symbols
            state = stepped(m, state[:, :active], inputs.take(last[:active], axis=1))[0]
            last = symbols[begin[:active] + t]
            waiting.append((state, last, np.arange(first, first + active)))
            held += active
            if held >= PASS and (held >= 8 * PASS or t % window == window - 1):
                settle()
                held = 0
    if waiting:
        settle()
    back = np.zeros(order.size)
    back[order] = out
    return back


class Descent:
    """Adagrad over a model's weights."""

    def __init__(self, m: Model, rate: float):
        self.m, self.rate = m, rate
        self.seen = {n: np.full_like(getattr(m, n), 1e-7) for n in m.NAMES}

    def step(self, name: str, gradient: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        seen = self.seen[name]
        seen[rows] += gradient * gradient
        getattr(self.m, name)[rows] -= self.rate * gradient / np.sqrt(seen[rows])


def learn(m: Model, symbols: np.ndarray, at: np.ndarray, p: Params, descent: Descent) -> float:
    """One pass of truncated backpropagation over the documents, laid into lanes; the mean loss. States begin anew with a document."""
    n, h = symbols.size, p.state
    if not n:
        return 0.0
    lanes = max(1, min(p.lanes, n // (8 * p.window)))
    size = -(-n // lanes)
    symbols = symbols.astype(SYMBOL)
    before = np.roll(symbols, 1)
    before[0] = END
    before[at[:-1]] = END
    stays = np.ones(n, bool)
    stays[at[:-1]] = False
    # A row for each step, a column for each lane.
    grid = lambda x, rest: np.ascontiguousarray(np.append(x, np.full(lanes * size - n, rest, x.dtype)).reshape(lanes, size).T)
    wanted, given, stays, counts = grid(symbols, END), grid(before, END), grid(stays, False), grid(np.ones(n, bool), False)
    state, loss = np.zeros((h, lanes), np.float32), 0.0
    for a in range(0, size, p.window):
        steps = min(p.window, size - a)
        table, read = np.ascontiguousarray(m.inputs.T), given[a : a + steps].astype(np.intp)
        states, kept = np.empty((steps, lanes, h), table.dtype), []
        for t in range(steps):
            old = state * stays[a + t]
            state, *rest = stepped(m, old, table.take(read[t], axis=1))
            states[t] = state.T
            kept.append((old, *rest))
        states, target, weight = states.reshape(-1, h), wanted[a : a + steps].ravel().astype(np.intp), counts[a : a + steps].ravel().astype(np.float32)
        total = max(1.0, float(weight.sum()))
        # The softmax of classes, then that of each class: the gradient of logits is the probability less what is.
        of, into, by_classes, by_bias = m.class_of[target], np.empty_like(states), np.zeros_like(m.classes), np.zeros_like(m.class_bias)
        for x in range(0, of.size, CACHED):
            some, at_, own = states[x : x + CACHED], of[x : x + CACHED], weight[x : x + CACHED]
            g, sums = shares(m.classes, m.class_bias, some)
            loss -= float(own @ log_of(m.classes, m.class_bias, some, g, sums, at_))
            g *= own / total / sums
            g[at_, np.arange(at_.size)] -= own / total
            into[x : x + CACHED] = g.T @ m.classes
            by_classes += g @ some
            by_bias += g.sum(axis=1)
        updates = [("classes", by_classes, slice(None)), ("class_bias", by_bias, slice(None))]
        order, runs = by_class(m, target)
        states, target, weight, inner = states[order], target[order], weight[order], np.zeros_like(into)
        for lo, hi, x, y in runs:
            of_words, at_ = (m.words[lo:hi], m.word_bias[lo:hi], states[x:y]), target[x:y] - lo
            g, sums = shares(*of_words)
            loss -= float(weight[x:y] @ log_of(*of_words, g, sums, at_))
            g *= weight[x:y] / total / sums
            g[at_, np.arange(y - x)] -= weight[x:y] / total
            inner[x:y] = g.T @ m.words[lo:hi]
            updates += [("words", g @ states[x:y], slice(lo, hi)), ("word_bias", g.sum(axis=1), slice(lo, hi))]
        into[order] += inner
        into = into.reshape(steps, lanes, h)
        inputs = np.empty((3 * h, steps * lanes + 16), table.dtype)  # 16 more, as rows that are a power of two apart share their place in a cache
        recurrent, back = np.zeros_like(m.recurrent), np.zeros((h, lanes), table.dtype)
        for t in range(steps - 1, -1, -1):
            old, r, z, new, part = kept[t]
            back += into[t].T
            own = np.empty((3 * h, lanes), table.dtype)
            dr, dz, dn = own[:h], own[h : 2 * h], own[2 * h :]
            z_left = 1 - z
            np.multiply(new, new, out=dn)
            np.subtract(1, dn, out=dn)
            dn *= back
            dn *= z_left
            np.subtract(old, new, out=dz)
            dz *= back
            dz *= z
            dz *= z_left
            np.multiply(dn, part, out=dr)
            dr *= r
            dr *= 1 - r
            inputs[:, t * lanes : (t + 1) * lanes] = own
            dn *= r
            recurrent += old @ own.T
            back *= z
            back += m.recurrent @ own
            back *= stays[a + t]
        read = read.ravel()
        order, first = sorted_runs(read)
        summed = np.add.reduceat(inputs.take(order, axis=1), first, axis=1)
        descent.step("inputs", np.ascontiguousarray(summed.T), read[order[first]])
        descent.step("recurrent", np.clip(recurrent, -1, 1))
        for name, gradient, which in updates:
            descent.step(name, gradient, which)
    return loss / n


def one_thread() -> None:
    """Keeps numpy's products in this task's own thread: with more, threads wait for one another in a loop, at the cost of twice the CPU and no time won."""
    maps = Path("/proc/self/maps")
    paths = {line.split()[-1] for line in maps.read_text().splitlines() if "openblas" in line} if maps.exists() else set()
    for path in paths:
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)


class Reader:
    """Texts as symbols of the model, by the table of frequent words that every task has."""

    def __init__(self, words: list[bytes], symbols: int):
        self.place = {w: k for k, w in enumerate(words)}
        self.symbol = np.full(len(words) + 1, RARE, dtype=SYMBOL)  # the last one for place -1
        self.symbol[: symbols - 2] = np.arange(2, symbols)

    def read(self, text: bytes) -> tuple[np.ndarray, np.ndarray, Counter[bytes]]:
        """The text's symbols with its end; the places in the table of its words (-1: none); and the words without one, with how often."""
        words = words_of(text)
        places = np.fromiter(map(self.place.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        lacking = []
        for k in np.flatnonzero(places < 0).tolist():  # a long word is not in the table but by its digest
            word = words[k]
            if len(word) > LONGEST:
                word = key_of(word)
                places[k] = self.place.get(word, -1)
                if places[k] >= 0:
                    continue
            lacking.append(word)
        symbols = np.full(places.size + 1, END, dtype=SYMBOL)
        symbols[:-1] = self.symbol[places]
        return symbols, places, Counter(lacking)


def symbols_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of encoded documents, one after another, and where each one's begin."""
    sizes = pc.binary_length(column).to_numpy().astype(np.int64) // SYMBOL.itemsize
    return np.frombuffer(b"".join(column.to_pylist()), dtype=SYMBOL).astype(np.int32), np.concatenate([[0], np.cumsum(sizes)])


def _learned(batches: Iterator[pa.RecordBatch], m: Model, p: Params) -> Iterator[pa.RecordBatch]:
    """chunk, part, tokens, weights (times tokens) of the model that this task's documents lead to."""
    from pyspark import TaskContext

    one_thread()
    descent, tokens = Descent(m, p.later), 0
    for batch in batches:
        symbols, at = symbols_of(batch.column(0))
        learn(m, symbols, at, p, descent)
        tokens += symbols.size
    if tokens:
        flat = m.flat().astype(np.float64) * tokens
        part = (TaskContext.get().partitionId() if TaskContext.get() else 0) % PARTS
        yield weights_batch({k: flat[k * CHUNK : (k + 1) * CHUNK] for k in range(-(-flat.size // CHUNK))}, part, tokens)
    release()


WEIGHTS = "chunk int, part int, tokens long, weights binary"


def weights_batch(chunks: dict[int, np.ndarray], part: int, tokens: int | dict[int, int]) -> pa.RecordBatch:
    n = [tokens[k] if isinstance(tokens, dict) else tokens for k in chunks]
    return pa.RecordBatch.from_arrays([pa.array(list(chunks), pa.int32()), pa.array([part] * len(chunks), pa.int32()), pa.array(n, pa.int64()), pa.array([w.tobytes() for w in chunks.values()], pa.binary())], names=["chunk", "part", "tokens", "weights"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a task's rows by chunk: as many as a model has chunks, however many rows there are."""
    sums: dict[int, np.ndarray] = {}
    tokens: dict[int, int] = {}
    for batch in batches:
        for chunk, n, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            one = np.frombuffer(data)
            sums[chunk] = sums[chunk] + one if chunk in sums else one
            tokens[chunk] = tokens.get(chunk, 0) + n
    yield weights_batch(sums, 0, tokens)


def fit(train: DataFrame, counts: Counts, p: Params) -> Model:
    """The model: begun on a bounded sample, then learnt from all of train (key, symbols) in its tasks and averaged."""
    m = Model(counts, p)
    # About so many keys by their hash, and of each one document; one beyond a megabyte does not take part in the beginning.
    order = F.xxhash64(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(p.seed))
    share = min(1.0, p.warm / max(1, counts.ends))
    short = train.where((F.octet_length("symbols") < 1 << 20) & (order <= min(2**63 - 1, int(share * 2**64) - 2**63)))
    chosen = short.select("key").distinct().limit(2 * p.warm)
    found = short.join(F.broadcast(chosen), "key").groupBy("key").agg(F.min("symbols").alias("symbols")).toPandas().sort_values("key")["symbols"]
    if len(found):
        symbols, at = symbols_of(pa.array([bytes(x) for x in found], pa.binary()))
        descent = Descent(m, p.rate)
        for _ in range(p.epochs):
            learn(m, symbols, at, replace(p, lanes=max(8, p.lanes // 4)), descent)
    replicas = train.select("symbols").mapInArrow(partial(_learned, m=m, p=p), WEIGHTS)
    some = replicas.repartition(PARTS, "chunk", "part").mapInArrow(_summed, WEIGHTS)
    done: pd.DataFrame = some.repartition(8, "chunk").mapInArrow(_summed, WEIGHTS).toPandas().sort_values("chunk")
    if len(done):
        m.load(np.concatenate([np.frombuffer(w) / n for w, n in zip(done["weights"], done["tokens"], strict=True)]))
    return m


ENCODED = "n_tokens long, n_known long, base double, beyond double, rare array<struct<word:binary,n:bigint>>, symbols binary"


def _encoded(batches: Iterator[pa.RecordBatch], counts: Counts, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The other columns, and of each text: tokens, those known by the table, sums over those, the words that the table lacks, and its symbols."""
    reader = Reader(counts.words, counts.symbols)
    logs = np.log10(counts.counts + 0.5)
    end = np.log10(counts.ends + 0.5)
    kind = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        tokens, known, sums, beyond, lists, words, times, encoded = [], [], [], [], [0], [], [], []
        for _, _, texts in text_passes(column):
            for text in texts:
                symbols, places, lacking = reader.read(text)
                held = places[places >= 0]
                tokens.append(symbols.size)
                known.append(held.size + (counts.ends > 0))
                sums.append(logs[held].sum() + end - symbols.size * counts.floor)
                # Rare words to the model: what is known of them here, over all that are rare.
                beyond.append(logs[held[held >= counts.symbols - 2]].sum() - np.count_nonzero(symbols == RARE) * counts.rare_floor)
                words += lacking.keys()
                times += lacking.values()
                lists.append(len(words))
                encoded.append(symbols.tobytes())
        arrays = [
            pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(sums, pa.float64()), pa.array(beyond, pa.float64()),
            pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(times, pa.int64())], fields=list(kind.value_type))),
            pa.array(encoded, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), *arrays], names=[*names, *(x.split()[0] for x in ENCODED.split(", "))])
    release()


def _scored(batches: Iterator[pa.RecordBatch], m: Model, window: int) -> Iterator[pa.RecordBatch]:
    """The columns before symbols, and the model's log10 of each document's probability with what is known of rare words."""
    one_thread()
    for batch in batches:
        symbols, at = symbols_of(batch.column(batch.num_columns - 1))
        score = likelihoods(m, symbols, at, window) / np.log(10) + batch.column(batch.schema.get_field_index("beyond")).to_numpy()
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], names=[*batch.schema.names[:-1], "score"])
    release()


def score_documents(documents: DataFrame, train: Column, p: Params = Params(), id_column: str = "doc_id") -> DataFrame:
    """doc_id, trains, n_tokens, n_known, train_tokens, base_score, score of every row of documents (doc_id, text); rows where train holds are learnt from."""
    rows = documents.select(F.col(id_column), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(train, F.lit(True)).alias("trains"))
    counts, table = count(rows.where("trains").select("text"), p)
    kind = documents.schema[id_column].dataType.simpleString()
    # Texts are read into symbols once; the model is learnt from and asked about those.
    encoded = rows.mapInArrow(partial(_encoded, counts=counts, names=[id_column, "trains"]), f"{id_column} {kind}, trains boolean, {ENCODED}")
    encoded = written(encoded.withColumn("row", F.monotonically_increasing_id()))
    m = fit(encoded.where("trains").select(F.col(id_column).alias("key"), "symbols"), counts, p)
    kept = ["row", id_column, "trains", "n_tokens", "n_known", "base", "beyond"]
    scored = encoded.select(*kept, "symbols").mapInArrow(partial(_scored, m=m, window=p.window), f"row long, {id_column} {kind}, trains boolean, n_tokens long, n_known long, base double, beyond double, score double")
    # Words that the table lacks: one row for each document and word, looked up by a join; none of them is frequent.
    asked = encoded.select("row", F.explode("rare").alias("w")).select("row", "w.word", F.col("w.n").alias("times"))
    met = asked.join(table, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    more = met.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("also"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.join(more, "row", "left").select(
        id_column, "trains", "n_tokens", (F.col("n_known") + zero("also")).alias("n_known"), F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more")).alias("base_score"), (F.col("score") + zero("more")).alias("score"),
    )
