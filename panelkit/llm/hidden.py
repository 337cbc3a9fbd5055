"""Hidden Markov language model (operator 2).

Words are emitted by a few latent states, trained by Baum-Welch: each partition adds up the expected counts of its
documents, Spark adds those of all partitions, the driver turns them into the next model. Scaled forward recursion
then gives the exact likelihood of every text. What the driver and the broadcasts hold is bounded by the number of
states and of head words, not by the corpus: words beyond the most frequent ones share one class in each state, and
within the class a word has its own share of counts, looked up by a join.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelkit.functions.durable import settle

#: most frequent words, which each state emits by their own probabilities
HEAD = 65_536
STATES = 8
ITERATIONS = 4
SEED = 11
#: held out: documents whose checksum leaves this remainder
FOLDS, HELD_OUT = 7, 2
#: weight of the corpus distribution in each state's emissions, in words
PRIOR = 50.0
#: sequences that are computed side by side, and steps between stored forward vectors
LANES, BLOCK = 1024, 128
#: expected counts are added up in whole numbers of this part, so that their order doesn't matter
PART = 65_536
#: distinct words a task holds before it hands their counts on
HELD_WORDS = 400_000
END = b""


def is_held_out(doc_id) -> bool:
    """A null id is in training."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of anything but ASCII blanks, with A-Z in lower case (bytes.split and lower know only those)."""
    return text.lower().split() if text else []


def _texts(batch):
    return zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())


def count_words(docs: DataFrame) -> DataFrame:
    """token (binary, the end of a text is empty) and c over the training documents."""

    def count(batches):
        held: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["token", "c"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in _texts(batch):
                if not is_held_out(doc_id):
                    held.update(words_of(text))
                    held[END] += 1
                    if len(held) > HELD_WORDS:
                        yield flush()
        yield flush()

    partial = docs.select("doc_id", "text").mapInArrow(count, "token binary, c long")
    return settle(partial.groupBy("token").agg(F.sum("c").alias("c")))


class Vocabulary:
    """The head words with their counts, and the sums of all words."""

    def __init__(self, words: list[bytes], counts: list[int], n: int, v: int, ends: int):
        self.words, self.counts, self.n, self.v, self.ends = words, np.array(counts, dtype=np.int64), n, v, ends
        self.tail = len(words)  # number of the class of all other words
        self.end = self.tail + 1
        self.tail_n = n - ends - int(self.counts.sum())
        self.tail_v = v - (ends > 0) - len(words)

    def numbers(self) -> dict[bytes, int]:
        if not hasattr(self, "_numbers"):
            self._numbers = {w: i for i, w in enumerate(self.words)}
        return self._numbers

    def __getstate__(self):
        return {k: x for k, x in self.__dict__.items() if k != "_numbers"}


def vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    end = F.octet_length("token") == 0
    n, v, ends = counts.agg(F.sum("c"), F.count("*"), F.sum(F.when(end, F.col("c")))).first()
    top = counts.filter(~end).orderBy(F.desc("c"), "token").limit(head).toArrow()
    return Vocabulary([bytes(x) for x in top.column(0).to_pylist()], top.column(1).to_pylist(), n or 0, v, ends or 0)


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Texts as numbers of head words, written once: row, doc_id, held_out, n_tokens, base (sum of log10(c + 1) over the
    known part), numbers (int32), tail (the other words)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def number(batches):
        known = shared.value
        find, tail = known.numbers().get, known.tail
        weights = np.append(np.log10(known.counts + 1.0), 0.0)
        end = np.log10(known.ends + 1.0)
        for batch in batches:
            out = {c: [] for c in ("held_out", "n_tokens", "base", "numbers", "tail")}
            for doc_id, text in zip(batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
                words = words_of(text)
                numbers = np.fromiter((find(w, tail) for w in words), np.int32, len(words))
                out["held_out"].append(is_held_out(doc_id))
                out["n_tokens"].append(len(words) + 1)
                out["base"].append(float(weights[numbers].sum() + end))
                out["numbers"].append(numbers.tobytes())
                out["tail"].append([words[i] for i in np.flatnonzero(numbers == tail)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out["held_out"], pa.bool_()), pa.array(out["n_tokens"], pa.int64()),
                 pa.array(out["base"], pa.float64()), pa.array(out["numbers"], pa.binary()), pa.array(out["tail"], pa.list_(pa.binary()))],
                names=["row", "doc_id", *out])

    key = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return settle(rows.mapInArrow(
        number, f"row long, doc_id {key}, held_out boolean, n_tokens long, base double, numbers binary, tail array<binary>"))


def lanes(texts: list[np.ndarray], end: int):
    """Texts, each with its end, laid out in lanes to be computed side by side: numbers [step, lane], lanes in use at
    each step (they are in order of length), and the place (lane, first, last step + 1) of each text."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    total = sum(map(len, texts)) + len(texts)
    room = max(len(texts[order[0]]) + 1, -(-total // LANES))
    filled: list[list[int]] = [[]]
    left = room
    for i in order:
        if len(texts[i]) + 1 > left:
            filled.append([])
            left = room
        filled[-1].append(i)
        left -= len(texts[i]) + 1
    lengths = [sum(len(texts[i]) + 1 for i in lane) for lane in filled]
    by_length = sorted(range(len(filled)), key=lambda x: -lengths[x])
    grid = np.full((lengths[by_length[0]], len(filled)), end, dtype=np.int32)
    places = [(0, 0, 0)] * len(texts)
    for column, lane in enumerate(by_length):
        at = 0
        for i in filled[lane]:
            grid[at:at + len(texts[i]), column] = texts[i]
            places[i] = (column, at, at + len(texts[i]) + 1)
            at += len(texts[i]) + 1
    sizes = np.array([lengths[x] for x in by_length])
    used = np.searchsorted(-sizes, -np.arange(len(grid)), side="left")
    return grid, used, places


class Model:
    """Transitions between the states, the last of which emits the end of a text, also begins one, and nothing else;
    emissions: a row for each head word, the class of other words, and the end."""

    def __init__(self, transitions: np.ndarray, emissions: np.ndarray):
        self.transitions, self.emissions = transitions, emissions

    def _start(self, n: int) -> np.ndarray:
        alpha = np.zeros((n, len(self.transitions)))
        alpha[:, -1] = 1
        return alpha

    def log10(self, texts: list[np.ndarray]) -> np.ndarray:
        """The exact log10 likelihood of each text by scaled forward recursion."""
        if not texts:
            return np.zeros(0)
        grid, used, places = lanes(texts, len(self.emissions) - 1)
        alpha = self._start(grid.shape[1])
        scale = np.ones(grid.shape)
        for t in range(len(grid)):
            n = used[t]
            step = (alpha[:n] @ self.transitions) * self.emissions[grid[t, :n]]
            scale[t, :n] = step.sum(axis=1)
            alpha[:n] = step / scale[t, :n, None]
        logs = np.log10(scale)
        return np.array([logs[a:b, lane].sum() for lane, a, b in places])

    def expect(self, texts: list[np.ndarray], emitted: np.ndarray, moved: np.ndarray) -> None:
        """Add the expected emissions [word, state] and transitions of the texts by forward-backward recursion. Forward
        vectors are kept at every BLOCK-th step and computed again between, so memory doesn't grow with the texts."""
        if not texts:
            return
        grid, used, _ = lanes(texts, len(self.emissions) - 1)
        forward, states = self.transitions, len(self.transitions)
        kept = []
        alpha = self._start(grid.shape[1])
        for t in range(len(grid)):
            if t % BLOCK == 0:
                kept.append(alpha.copy())
            n = used[t]
            step = (alpha[:n] @ forward) * self.emissions[grid[t, :n]]
            alpha[:n] = step / step.sum(axis=1)[:, None]
        beta = np.ones((grid.shape[1], states))
        joined = np.zeros((states, states))
        for b in range(len(kept) - 1, -1, -1):
            first, last = b * BLOCK, min(len(grid), (b + 1) * BLOCK)
            width = used[first]
            alphas = np.zeros((last - first + 1, width, states))
            alphas[0] = kept[b][:width]
            emission = self.emissions[grid[first:last, :width]]
            scales = np.ones((last - first, width))
            for k in range(last - first):
                n = used[first + k]
                step = (alphas[k, :n] @ forward) * emission[k, :n]
                scales[k, :n] = step.sum(axis=1)
                alphas[k + 1, :n] = step / scales[k, :n, None]
            for k in range(last - first - 1, -1, -1):
                n = used[first + k]
                weight = emission[k, :n] * beta[:n] / scales[k, :n, None]
                alphas[k + 1, :n] *= beta[:n]  # from here on the probability of each state
                joined += alphas[k, :n].T @ weight
                beta[:n] = weight @ forward.T
            numbers = grid[first:last, :width].ravel()
            for s in range(states - 1):  # lanes out of use have zeros
                emitted[:, s] += np.bincount(numbers, weights=alphas[1:, :, s].ravel(), minlength=len(emitted))
        moved += joined * forward


def _first_model(vocabulary: Vocabulary, states: int, seed: int) -> Model:
    """States that favour random words and tend to stay."""
    rng = np.random.RandomState(seed)
    corpus = _corpus(vocabulary)
    emissions = corpus[:, None] * np.exp(0.5 * rng.standard_normal((len(corpus), states)))
    transitions = np.full((states + 1, states + 1), 0.1 / (states + 1))
    transitions[:-1, :-1] += 0.9 * np.eye(states)
    return _normalised(transitions, emissions)


def _corpus(vocabulary: Vocabulary) -> np.ndarray:
    counts = np.append(vocabulary.counts, vocabulary.tail_n) + 1.0
    return counts / counts.sum()


def _normalised(transitions: np.ndarray, emissions: np.ndarray) -> Model:
    states = emissions.shape[1]
    full = np.zeros((len(emissions) + 1, states + 1))
    full[:-1, :-1] = emissions / emissions.sum(axis=0)
    full[-1, -1] = 1
    return Model(transitions / transitions.sum(axis=1)[:, None], full)


def _numbers(batch, at: int) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int32) for x in batch.column(at).to_pylist()]


def train(encoded: DataFrame, vocabulary: Vocabulary, states=STATES, iterations=ITERATIONS, seed=SEED) -> Model:
    """Baum-Welch over all training documents in every iteration."""
    context = encoded.sparkSession.sparkContext
    model = _first_model(vocabulary, states, seed)
    corpus = _corpus(vocabulary)
    columns = [f"s{i}" for i in range(states + 1)]
    for _ in range(iterations):
        shared = context.broadcast(model)

        def expected(batches):
            current = shared.value
            emitted = np.zeros((len(current.emissions), states + 1))
            moved = np.zeros((states + 1, states + 1))
            for batch in batches:
                current.expect(_numbers(batch, 0), emitted, moved)
            counts = np.rint(np.concatenate([emitted, moved]) * PART).astype(np.int64)
            some = np.flatnonzero(counts.any(axis=1))
            for at in range(0, len(some), 8192):
                part = some[at:at + 8192]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), *[pa.array(counts[part, i]) for i in range(states + 1)]], names=["at", *columns])

        partial = encoded.filter("not held_out").select("numbers").mapInArrow(expected, ", ".join(["at int", *[f"{c} long" for c in columns]]))
        sums = partial.groupBy("at").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
        total = np.zeros((len(model.emissions) + states + 1, states + 1))
        total[sums.column(0).to_numpy()] = np.stack([sums.column(c).to_numpy() for c in columns], axis=1) / PART
        split = len(model.emissions)
        model = _normalised(total[split:] + 1.0 / (states + 1), total[:split - 1, :states] + PRIOR * corpus[:, None])
        shared.unpersist()
    return model


def _likelihoods(encoded: DataFrame, model: Model) -> DataFrame:
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            found = shared.value.log10(_numbers(batch, 5))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(found, pa.float64())], names=[*batch.schema.names[:5], "likelihood"])

    key = encoded.schema["doc_id"].dataType.simpleString()
    rows = encoded.select("row", "doc_id", "held_out", "n_tokens", "base", "numbers")
    return rows.mapInArrow(score, f"row long, doc_id {key}, held_out boolean, n_tokens long, base double, likelihood double")


def score(docs: DataFrame, head=HEAD, states=STATES, iterations=ITERATIONS, seed=SEED) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    base_score adds log10((c + 1) / (N + V + 1)) over the words and the end; score is the model's log10 likelihood of
    the same. Null and blank texts are an end alone. Rows that repeat count each, a null id is in training. Without
    training documents both scores come from the smoothing alone. No rows give no rows.
    """
    counts = count_words(docs)
    known = vocabulary(counts, head)
    encoded = encode(docs, known)
    model = train(encoded, known, states, iterations, seed)
    words = encoded.select("row", F.explode("tail").alias("token"))
    c = F.coalesce(F.col("c"), F.lit(0))
    tails = words.join(counts, "token", "left").groupBy("row").agg(
        F.count("*").alias("_n"), F.sum((c > 0).cast("long")).alias("_known"), F.sum(F.log10(c + 1.0)).alias("_logs")
    )
    zero = lambda x: F.coalesce(F.col(x), F.lit(0))
    in_class = float(np.log10(known.tail_n + known.tail_v + 1))
    both = float(np.log10(known.n + known.v + 1))
    unknown = zero("_n") - zero("_known") + (0 if known.ends else 1)
    return _likelihoods(encoded, model).join(tails, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_tokens") - unknown).alias("n_known"),
        F.lit(known.n).cast("long").alias("train_tokens"),
        (F.col("base") + zero("_logs") - F.col("n_tokens") * both).alias("base_score"),
        (F.col("likelihood") + zero("_logs") - zero("_n") * in_class).alias("score"),
    )
