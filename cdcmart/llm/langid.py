"""Language identification: a bidirectional gated recurrent network over bytes, in numpy.

Texts are cut into windows of ``SPAN`` bytes. The network reads each window forwards and backwards, gives every position a
probability for each language, and the mean over all positions of a document is the document's probability.
It is trained by backpropagation through time on a bounded sample of labelled documents; the weights,
some ten thousand numbers, are then applied to every whole text in the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.llm.common import free_name, in_slices, map_arrow, quoted, ship_package
from cdcmart.llm.words import LOWER

SPAN = 64
HIDDEN = 8
_PAD = 256

# The bounded sample: documents of each language and of all languages together, pieces of each document (anywhere in
# it), characters of a piece. All languages are learned.
DOCUMENTS = 600
MOST_DOCUMENTS = 64 * DOCUMENTS
PIECES = 3
PIECE_CHARS = 3 * SPAN

_LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"

# A document whose mean probability is below so many times that of chance, or below a half if that is more, has no
# language the network knows.
LEAST_TIMES_CHANCE = 1.6


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts, one column each and padded at the end; the number of windows of each text."""
    counts = np.array([-(-len(t) // SPAN) for t in texts], np.int64)
    flat = np.full(int(counts.sum()) * SPAN, _PAD, np.int16)
    at = 0
    for text, count in zip(texts, counts.tolist()):
        flat[at : at + len(text)] = LOWER[np.frombuffer(text, np.uint8)]
        at += count * SPAN
    return np.ascontiguousarray(flat.reshape(-1, SPAN).T), counts


@dataclass
class Direction:
    """Weights of one reading direction. Rows: update gate, reset gate, candidate."""

    inputs: np.ndarray  # (3 * hidden, 257): one column per byte, biases included
    state: np.ndarray  # (3 * hidden, hidden)
    shift: np.ndarray  # (hidden, 1): bias inside the reset

    def run(self, steps: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """States after every step of ``steps`` (time, windows): (time, hidden, windows)."""
        size = self.state.shape[1]
        n = steps.shape[1]
        out = np.empty((len(steps), size, n), np.float32)
        h = np.zeros((size, n), np.float32)
        given, driven = np.empty((3 * size, n), np.float32), np.empty((3 * size, n), np.float32)
        for t, symbols in enumerate(steps):
            np.take(self.inputs, symbols, axis=1, out=given, mode="clip")
            np.matmul(self.state, h, out=driven)
            gates = given[: 2 * size]
            gates += driven[: 2 * size]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            update, reset = gates[:size], gates[size:]
            inner = driven[2 * size :]
            inner += self.shift
            candidate = out[t]
            np.multiply(reset, inner, out=candidate)
            candidate += given[2 * size :]
            np.tanh(candidate, out=candidate)
            if keep is not None:
                keep["update"].append(update.copy())
                keep["reset"].append(reset.copy())
                keep["inner"].append(inner.copy())
                keep["candidate"].append(candidate.copy())
            # h' = candidate + update * (h - candidate)
            np.subtract(h, candidate, out=inner)
            inner *= update
            candidate += inner
            h = candidate
        return out

    def learn(self, steps: np.ndarray, states: np.ndarray, keep: dict, pull: np.ndarray) -> list[np.ndarray]:
        """Gradients by going back through time; ``pull`` is the loss by each state, (time, hidden, windows)."""
        size, n = self.state.shape[1], steps.shape[1]
        by_input, by_state = np.zeros_like(self.inputs), np.zeros_like(self.state)
        by_shift = np.zeros_like(self.shift)
        back = np.zeros((size, n), np.float32)
        zero = np.zeros((size, n), np.float32)
        for t in range(len(steps) - 1, -1, -1):
            h = states[t - 1] if t else zero
            update, reset, inner, candidate = (keep[k][t] for k in ("update", "reset", "inner", "candidate"))
            back += pull[t]
            d_candidate = back * (1 - update) * (1 - candidate * candidate)
            d_update = back * (h - candidate) * update * (1 - update)
            d_reset = d_candidate * inner * reset * (1 - reset)
            d_inner = d_candidate * reset
            d_given = np.concatenate([d_update, d_reset, d_candidate])
            d_driven = np.concatenate([d_update, d_reset, d_inner])
            by_state += d_driven @ h.T
            by_shift += d_inner.sum(axis=1, keepdims=True)
            order = np.argsort(steps[t], kind="stable")
            symbols = steps[t][order]
            firsts = np.flatnonzero(np.diff(symbols, prepend=-1))
            by_input[:, symbols[firsts]] += np.add.reduceat(d_given[:, order], firsts, axis=1)
            back = back * update + self.state.T @ d_driven
        return [by_input, by_state, by_shift]


@dataclass
class Network:
    """Two directions and the layer that labels each position."""

    languages: list[str]
    forth: Direction
    back: Direction
    labels: np.ndarray  # (languages, 2 * hidden)
    bias: np.ndarray  # (languages, 1)

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        random = np.random.default_rng(seed)

        def direction() -> Direction:
            return Direction(
                random.normal(0, 0.5, (3 * hidden, _PAD + 1)).astype(np.float32),
                random.normal(0, hidden**-0.5, (3 * hidden, hidden)).astype(np.float32),
                np.zeros((hidden, 1), np.float32),
            )

        return cls(
            languages,
            direction(),
            direction(),
            random.normal(0, hidden**-0.5, (len(languages), 2 * hidden)).astype(np.float32),
            np.zeros((len(languages), 1), np.float32),
        )

    @property
    def weights(self) -> list[np.ndarray]:
        return [
            *(self.forth.inputs, self.forth.state, self.forth.shift),
            *(self.back.inputs, self.back.state, self.back.shift),
            *(self.labels, self.bias),
        ]

    def positions(self, windows: np.ndarray, keep: tuple[dict, dict] | None = None):
        """Probabilities (time, languages, windows), and the states of both directions."""
        forth = self.forth.run(windows, keep and keep[0])
        back = self.back.run(windows[::-1], keep and keep[1])
        size = forth.shape[1]
        scores = np.matmul(self.labels[:, :size], forth)
        scores += np.matmul(self.labels[:, size:], back[::-1])
        scores += self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores, forth, back

    def gradients(self, windows: np.ndarray, wanted: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over all positions that are no padding, and its gradients; ``wanted``: a language per window."""
        names = ("update", "reset", "inner", "candidate")
        keep = ({k: [] for k in names}, {k: [] for k in names})
        scores, forth, back = self.positions(windows, keep)
        real = (windows != _PAD).astype(np.float32)
        total = float(real.sum())
        column = np.arange(windows.shape[1])
        loss = -float((np.log(scores[:, wanted, column] + 1e-9) * real).sum()) / total
        wrong = scores
        wrong[:, wanted, column] -= 1
        wrong *= real[:, None, :] / total
        size = forth.shape[1]
        turned = back[::-1]
        by_labels = np.concatenate(
            [np.einsum("tkn,thn->kh", wrong, forth, optimize=True), np.einsum("tkn,thn->kh", wrong, turned, optimize=True)],
            axis=1,
        )
        by_bias = wrong.sum(axis=(0, 2))[:, None]
        own = self.forth.learn(windows, forth, keep[0], np.matmul(self.labels[:, :size].T, wrong))
        other = self.back.learn(windows[::-1], back, keep[1], np.matmul(self.labels[:, size:].T, wrong)[::-1])
        return loss, [*own, *other, by_labels, by_bias]

    def pooled(self, texts: list[bytes], at_once: int = 2048) -> np.ndarray:
        """Mean probabilities of each text over all its bytes; zeros for an empty text."""
        windows, counts = windows_of(texts)
        sums = np.zeros((windows.shape[1], len(self.languages)))
        for begin in range(0, windows.shape[1], at_once):
            part = np.ascontiguousarray(windows[:, begin : begin + at_once])
            scores, _, _ = self.positions(part)
            scores *= (part != _PAD)[:, None, :]
            sums[begin : begin + at_once] = scores.sum(axis=0).T
        out = np.zeros((len(texts), len(self.languages)))
        np.add.at(out, np.repeat(np.arange(len(texts)), counts), sums)
        return out / np.maximum([[len(t)] for t in texts], 1)


def train(
    samples: list[tuple[str, str]], hidden: int = HIDDEN, steps: int = 260, batch: int = 320, seed: int = 7
) -> Network | None:
    """Fit the network to (language, text) pairs; None without any. Every language is drawn equally often."""
    languages = sorted({lang for lang, _ in samples})
    if not languages:
        return None
    network = Network.fresh(languages, hidden, seed)
    windows, counts = windows_of([text.encode() for _, text in samples])
    owner = np.repeat([languages.index(lang) for lang, _ in samples], counts)
    pools = [np.flatnonzero(owner == k) for k in range(len(languages))]
    pools = [(k, p) for k, p in enumerate(pools) if len(p)]
    if not pools:
        return network
    random = np.random.default_rng(seed)
    weights = network.weights
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        drawn = [(k, random.choice(p, -(-batch // len(pools)))) for k, p in pools]
        chosen = np.concatenate([p for _, p in drawn])
        wanted = np.repeat([k for k, _ in drawn], [len(p) for _, p in drawn])
        _, slopes = network.gradients(np.ascontiguousarray(windows[:, chosen]), wanted)
        size = float(np.sqrt(sum(float((g * g).sum()) for g in slopes)))
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, m, v in zip(weights, slopes, mean, square):
            g = g * min(1.0, 1.0 / max(size, 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return network


def remainder(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def fit(docs: DataFrame, documents: int = DOCUMENTS) -> Network | None:
    """Train on a bounded sample of the rows that are not held out: about ``documents`` of each language, fewer where
    all languages come to more than ``MOST_DOCUMENTS``, chosen by a hash of id and text, and of each a few pieces at places
    chosen likewise. A frequent id is sampled like any other, and repeated rows count once. Null texts, ids and
    languages teach nothing.
    """
    rows = docs.where((remainder() != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return None
    each = min(documents, MOST_DOCUMENTS / len(counts))
    rates = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, each / r["count"]))])
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    room = F.greatest(F.char_length("text") - PIECE_CHARS, F.lit(0)) + 1
    places = [F.pmod(F.xxhash64(F.col("doc_id"), F.lit(k + 2)), room).cast("int") + 1 for k in range(PIECES)]
    pieces = F.array(*[F.substring("text", p, F.lit(PIECE_CHARS)) for p in places])
    sample = (
        rows.where(chance < F.try_element_at(rates, F.col("lang")))
        .select("lang", F.explode(F.array_distinct(pieces)).alias("piece"))
        .distinct()
        .collect()
    )
    return train(sorted((r["lang"], r["piece"]) for r in sample))


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """Add lang_pred and score to every row, from its whole text alone.

    Texts that are null or hold no letter, and all texts where nothing was learned, get ``und`` and 0. Rows are kept as
    they are; added names that are taken get underscores.
    """
    ship_package(docs.sparkSession)
    names = [free_name(docs, "lang_pred"), free_name(docs, "score")]
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    )

    def step(batches):
        for batch in in_slices(batches, "text", 1 << 20):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if network and t and _LETTER.search(t)]
            begin = 0
            while begin < len(known):
                end, size, held = begin, 0, []
                while end < len(known) and (end == begin or size < SPAN * 4096):
                    held.append(texts[known[end]].encode())
                    size += len(held[-1])
                    end += 1
                pooled = network.pooled(held)
                best = pooled.argmax(axis=1)
                for i, k, row in zip(known[begin:end], best.tolist(), pooled):
                    langs[i], scores[i] = network.languages[k], float(min(1.0, max(0.0, row[k])))
                begin = end
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, *names],
            )

    return map_arrow(docs, step, schema)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; the network learns from the rest only."""
    found = predict(docs.select("doc_id", "text"), fit(docs))
    held_out = F.coalesce(remainder() == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def least_score(languages: int) -> float:
    """The mean probability from which a document counts as in one of so many languages."""
    return min(0.5, LEAST_TIMES_CHANCE / max(1, languages))


def known_only(docs: DataFrame, least: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose text is in a language of the corpus: not ``und``, and of at least the score ``least``, by
    default that of :func:`least_score`. Null texts and those without a letter leave; repeated rows and null ids
    stay as any other, and so do columns of any name."""
    network = fit(docs)
    found = predict(docs, network)
    lang, score = found.columns[-2:]
    bar = least if least is not None else least_score(len(network.languages) if network else 1)
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= bar)).select(*quoted(docs.columns))
