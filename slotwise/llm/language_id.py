"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.staging import fresh

#: Labelled rows that the network is trained on at most, and characters of each.
SAMPLE_ROWS, SAMPLE_CHARS = 4000, 256
MAX_LANGUAGES = 64
UNDETERMINED = "und"

HIDDEN = 12  # units a direction
TRAIN_BYTES = 32  # of a training sequence
RUN_BYTES = 64  # of the sequences that a text is cut into; states start anew in each
RUN_SEQUENCES = 2048  # that are run side by side
STEPS, BATCH, RATE = 300, 192, 0.02
PAD = 256

#: Share of the sample's rows that are left out of account as the lowest; weight of the shorter context in the counts.
LOW, BACKOFF = 0.005, 4.0
#: What limits leave below the lowest rows: this share of the way to chance, and this multiple of their distance.
SLACK_SCORE, SLACK_DISTANCE = 0.75, 1.5
LEAST_DISTANCE = 6.0  # in standard deviations, as texts are not spread as evenly as a normal distribution
LEAST_ROWS = 20  # of a sample for a limit of familiarity
PIECE_BYTES = 1 << 20  # of a text whose familiarity is looked up at once


def _sequences(text: bytes, length: int) -> np.ndarray:
    """All bytes of ``text`` in rows of ``length``, padded."""
    n = max(1, -(-len(text) // length))
    out = np.full(n * length, PAD, np.int16)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, length)


class Network:
    """Two gated recurrent layers, one a direction; the sum of their outputs labels every position.

    For the byte x and the state h: z, r = sigmoid(E_zr[x] + h U_zr),
    n = tanh(E_n[x] + r * (h U_n)), and the next state is n + z * (h - n).
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        self.languages = languages
        random = np.random.default_rng(seed)
        normal = lambda *shape: random.normal(0, 0.3, shape).astype(np.float32)
        self.weights = {
            "bytes": normal(2, 257, 3 * hidden),
            "states": normal(2, hidden, 3 * hidden),
            "out": normal(2, hidden, len(languages)),
            "bias": np.zeros(len(languages), np.float32),
        }
        self.random = random

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        """Logits (time, batch, language) of the sequences ``x`` (batch, time), and what the way back needs."""
        w = self.weights
        time, batch, hidden = x.shape[1], x.shape[0], w["states"].shape[1]
        seen = np.stack([x.T, x.T[::-1]], axis=1)  # time, direction, batch
        h = np.zeros((2, batch, hidden), np.float32)
        logits = np.zeros((time, batch, len(self.languages)), np.float32) + w["bias"]
        kept = []
        for t in range(time):
            a = np.stack([w["bytes"][d][seen[t, d]] for d in (0, 1)])
            g = h @ w["states"]
            zr = 1 / (1 + np.exp(-(a[..., : 2 * hidden] + g[..., : 2 * hidden])))
            z, r = zr[..., :hidden], zr[..., hidden:]
            n = np.tanh(a[..., 2 * hidden :] + r * g[..., 2 * hidden :])
            kept.append((h, z, r, n, g[..., 2 * hidden :]))
            h = n + z * (h - n)
            out = h @ w["out"]
            logits[t] += out[0]
            logits[time - 1 - t] += out[1]
        return logits, [seen, kept, h]

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over all positions but padding, through time."""
        w = self.weights
        logits, (seen, kept, last) = self._forward(x)
        time, batch = x.shape[1], x.shape[0]
        p = np.exp(logits - logits.max(-1, keepdims=True))
        p /= p.sum(-1, keepdims=True)
        p[:, np.arange(batch), y] -= 1
        p *= (x.T != PAD)[..., None] / np.float32((x != PAD).sum())
        grads = {name: np.zeros_like(v) for name, v in w.items()}
        grads["bias"] = p.sum((0, 1))
        into, after = np.zeros_like(last), last
        entered = np.zeros((time, 2, batch, w["bytes"].shape[2]), np.float32)
        for t in range(time - 1, -1, -1):
            h, z, r, n, g = kept[t]
            error = np.stack([p[t], p[time - 1 - t]])
            grads["out"] += after.transpose(0, 2, 1) @ error
            dh = into + error @ w["out"].transpose(0, 2, 1)
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * g * r * (1 - r)
            dg = np.concatenate([dz, dr, dn * r], -1)
            grads["states"] += h.transpose(0, 2, 1) @ dg
            entered[t] = np.concatenate([dz, dr, dn], -1)
            into = dh * z + dg @ w["states"].transpose(0, 2, 1)
            after = h
        for d in (0, 1):
            ids = seen[:, d].ravel()
            order = np.argsort(ids, kind="stable")
            found, first = np.unique(ids[order], return_index=True)
            grads["bytes"][d, found] = np.add.reduceat(entered[:, d].reshape(len(ids), -1)[order], first)
        return grads

    def train(self, texts: list[bytes], labels: list[str], steps: int = STEPS, batch: int = BATCH, rate: float = RATE) -> None:
        """Backpropagation through time with Adam; every language is drawn equally often."""
        number = {name: i for i, name in enumerate(self.languages)}
        parts = [_sequences(t, TRAIN_BYTES) for t in texts]
        x = np.concatenate(parts)
        y = np.repeat([number[name] for name in labels], [len(p) for p in parts])
        of = [np.flatnonzero(y == i) for i in range(len(self.languages))]
        first = {name: np.zeros_like(v) for name, v in self.weights.items()}
        second = {name: np.zeros_like(v) for name, v in self.weights.items()}
        for step in range(1, steps + 1):
            drawn = np.concatenate([self.random.choice(rows, -(-batch // len(of))) for rows in of])
            grads = self._gradients(x[drawn], y[drawn])
            pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for name, g in grads.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                step_ = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
                self.weights[name] = (self.weights[name] - pace * step_).astype(np.float32)

    def _label_sums(self, x: np.ndarray) -> np.ndarray:
        """For each sequence the sum of its positions' probabilities, padding left out."""
        w, hidden, count = self.weights, self.weights["states"].shape[1], len(self.languages)
        batch, time = x.shape
        half = np.ones(3 * hidden, np.float32)
        half[: 2 * hidden] = 0.5  # sigmoid(v) = (1 + tanh(v / 2)) / 2
        # units are rows and sequences columns, so that every gate is one block of memory
        tables = [np.ascontiguousarray((w["bytes"][d] * half).T) for d in (0, 1)]
        states = [np.ascontiguousarray((w["states"][d] * half).T) for d in (0, 1)]
        outs = [np.ascontiguousarray(w["out"][d].T) for d in (0, 1)]
        ids = np.ascontiguousarray(x.T, dtype=np.intp)
        logits = np.empty((2, time, count, batch), np.float32)
        for d in (0, 1):
            h = np.zeros((hidden, batch), np.float32)
            a, g = np.empty((3 * hidden, batch), np.float32), np.empty((3 * hidden, batch), np.float32)
            zr, n, z, r = g[: 2 * hidden], g[2 * hidden :], g[:hidden], g[hidden : 2 * hidden]
            for t in range(time) if d == 0 else range(time - 1, -1, -1):
                np.take(tables[d], ids[t], axis=1, out=a, mode="clip")
                np.matmul(states[d], h, out=g)
                zr += a[: 2 * hidden]
                np.tanh(zr, out=zr)
                zr *= 0.5
                zr += 0.5
                n *= r
                n += a[2 * hidden :]
                np.tanh(n, out=n)
                h -= n
                h *= z
                h += n
                np.matmul(outs[d], h, out=logits[d, t])
        p = logits[0]
        p += logits[1]
        p += w["bias"][:, None]
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        p *= (ids != PAD)[:, None]
        return p.sum(0).T

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """(text, language): the mean over all positions of the whole text; zeros for an empty one."""
        out = np.zeros((len(texts), len(self.languages)))
        rows, owners, waiting = [], [], 0

        def run() -> None:
            if waiting:
                np.add.at(out, np.concatenate(owners), self._label_sums(np.concatenate(rows)))

        for i, text in enumerate(texts):
            parts = _sequences(text, RUN_BYTES)
            for at in range(0, len(parts), RUN_SEQUENCES):
                rows.append(parts[at : at + RUN_SEQUENCES])
                owners.append(np.full(len(rows[-1]), i))
                waiting += len(rows[-1])
                if waiting >= RUN_SEQUENCES:
                    run()
                    rows, owners, waiting = [], [], 0
        run()
        return out / np.maximum([[len(t)] for t in texts], 1)


def training_rows(
    docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, share: float | None = 2.0
) -> DataFrame:
    """(text, lang) of at most ``rows`` labelled rows, ``chars`` of each from a place that a hash chooses.

    The labels are counted first. Then rows are drawn by the hash of their
    doc_id, about ``share`` times as many as are asked for, and of these the ones with the
    smallest hashes are taken, so that no task sends more than it must. Without
    a ``share`` all rows are drawn.
    """
    drawn = docs.where("lang is not null and text is not null")
    if share is not None:
        total = max(docs.where("lang is not null").count(), 1)
        limit = min(int(share * rows / total * (1 << 32)), 1 << 32)
        drawn = drawn.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < limit)
    drawn = drawn.where(F.col("text").rlike(r"\p{L}"))
    h = F.xxhash64("doc_id", "text")
    start = F.pmod(h, F.greatest(F.length("text") - chars, F.lit(1))) + 1
    cut = F.substring("text", start.cast("int"), F.lit(chars)).alias("text")
    return drawn.select(cut, "lang", h.alias("h")).orderBy("h", "text", "lang").limit(rows).select("text", "lang")


def _sample(docs: DataFrame, rows: int, chars: int) -> list[tuple[str, str]]:
    """``training_rows`` on the driver. Where repeated ids leave the draw short, all rows are drawn from."""
    found = [tuple(r) for r in training_rows(docs, rows, chars).collect()]
    return found if len(found) >= rows else [tuple(r) for r in training_rows(docs, rows, chars, None).collect()]


def train(labelled: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Network | None:
    """The network for the languages of a bounded sample of ``labelled`` (doc_id, text, lang); None without labels.

    The sample is ``rows * chars`` characters at most and the network has a
    fixed size, so neither the driver's work nor what it sends out grows.
    """
    return _train(_sample(labelled, rows, chars))


def _train(sample: list[tuple[str, str]]) -> Network | None:
    languages = sorted({lang for _, lang in sample})
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        return None
    network = Network(languages)
    network.train([t.encode() for t, _ in sample], [lang for _, lang in sample])
    return network


class Familiarity:
    """How likely a text's letters are after the two before them, by the trigrams of some texts.

    ASCII letters count in lower case, the bytes of others as they are; all that
    stands between letters is one symbol, and so are bytes that the texts lack.
    """

    def __init__(self, texts: list[bytes]):
        symbol = np.zeros(256, np.int32)
        symbol[65:91] = symbol[97:123] = np.arange(2, 28)
        symbol[128:] = np.arange(28, 156)
        seen = np.zeros(256, bool)
        for t in texts:
            seen[np.frombuffer(t, np.uint8)] = True
        kept = np.unique(symbol[seen | (symbol == 0)])
        names = np.full(156, 1, np.int32)
        names[kept] = np.where(kept > 1, np.cumsum(kept > 1) + 1, 0)
        self.symbols = names[symbol]
        self.size = n = int(self.symbols.max()) + 1
        threes = np.zeros(n**3)
        for t in texts:
            np.add.at(threes, self._places(t), 1)
        threes = threes.reshape(n, n, n)
        twos, ones = threes.sum(0), threes.sum((0, 1))
        p = (ones + 1) / (ones.sum() + n)
        p = (twos + BACKOFF * p) / (twos.sum(1, keepdims=True) + BACKOFF)
        p = (threes + BACKOFF * p) / (threes.sum(2, keepdims=True) + BACKOFF)
        self.logs = np.log(p).astype(np.float32).ravel()

    def _places(self, text: bytes) -> np.ndarray:
        s = np.zeros(len(text) + 3, np.int32)
        s[2:-1] = self.symbols[np.frombuffer(text, np.uint8)]
        return ((s[:-2] * self.size + s[1:-1]) * self.size + s[2:])[(s[1:-1] != 0) | (s[2:] != 0)]

    def of(self, text: bytes) -> np.ndarray:
        """The logarithms for the places of ``text`` that belong to a word."""
        return self.logs[self._places(text)]


@dataclass
class Limits:
    """What a text must reach to be in a language: a score, and a familiarity for its length.

    The distance of a text from its language is its mean familiarity less that
    of the language's rows, in standard deviations for a text of that length.
    """

    scores: dict[str, float]
    familiarity: Familiarity
    means: dict[str, float]
    within: float
    between: float
    distance: float

    def distance_of(self, text: bytes, lang: str) -> float:
        total, n = 0.0, 0
        for at in range(0, len(text), PIECE_BYTES):
            found = self.familiarity.of(text[at : at + PIECE_BYTES])
            total, n = total + float(found.sum(dtype=np.float64)), n + len(found)
        return (total / n - self.means[lang]) / float(np.sqrt(self.within / n + self.between)) if n else 0.0

    def accept(self, text: bytes, lang: str, score: float) -> bool:
        return score >= self.scores[lang] and self.distance_of(text, lang) >= self.distance


def _limits(network: Network, sample: list[tuple[str, str]]) -> Limits:
    """From the rows of ``sample`` that ``network`` labels right, familiarity by halves of which each is held against the other."""
    texts, labels = [t.encode() for t, _ in sample], [lang for _, lang in sample]
    p, chance = network.probabilities(texts), 1 / len(network.languages)
    right = [network.languages[k] == lang for k, lang in zip(p.argmax(1), labels, strict=True)]
    scores = {}
    for lang in network.languages:
        own = [x for x, r, name in zip(p.max(1), right, labels, strict=True) if r and name == lang]
        low = min(float(np.quantile(own, LOW, method="lower")), 1.0) if own else chance
        scores[lang] = low - SLACK_SCORE * (low - chance)
    halves = [Familiarity(texts[k::2]) for k in (0, 1)]
    found = [halves[1 - i % 2].of(t) for i, t in enumerate(texts)]
    of = {lang: [x for x, name in zip(found, labels, strict=True) if name == lang and len(x)] for lang in network.languages}
    means = {lang: float(np.mean([x.mean() for x in rows])) if rows else 0.0 for lang, rows in of.items()}
    every = [(x, means[lang]) for lang, rows in of.items() for x in rows]
    within = float(np.mean([x.var() for x, _ in every]))
    apart = np.array([x.mean() - m for x, m in every])
    between = max(float(np.mean(apart**2 - [within / len(x) for x, _ in every])), 1e-6)
    distances = apart / np.sqrt([within / len(x) + between for x, _ in every])
    lowest = min(float(np.quantile(distances, LOW, method="lower")), -LEAST_DISTANCE)
    distance = SLACK_DISTANCE * lowest if len(texts) >= LEAST_ROWS else -np.inf
    return Limits(scores, Familiarity(texts), means, within, between, distance)


def train_with_limits(
    labelled: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS
) -> tuple[Network | None, Limits | None]:
    """``train``, and the limits below which a text is in none of the network's languages, from the same sample."""
    sample = _sample(labelled, rows, chars)
    network = _train(sample)
    return network, _limits(network, sample) if network else None


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` with lang_pred and score: the language most probable on average over all bytes of the text.

    Texts that are null or have no letter get ``und`` and score 0, as all do
    without a network. Columns named lang_pred or score are replaced. The label
    of a row is no input.
    """

    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [(UNDETERMINED, 0.0)] * len(texts)
            at = [i for i, t in enumerate(texts) if t is not None]
            if network is not None and at:
                for i, p in zip(at, network.probabilities([texts.iloc[i] for i in at]), strict=True):
                    best = int(p.argmax())
                    found[i] = network.languages[best], float(min(p[best], 1.0))
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    out = docs.drop("lang_pred", "score")
    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("binary"))
    return out.select("*", F.inline(F.array(label(lettered))))


def keep_identified(docs: DataFrame, network: Network | None, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` in a language of the network with ``min_score`` at least, columns as given."""
    row = docs.select(F.struct(*docs.columns).alias("row"), "text")
    marked = predict(row, network)
    return marked.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score)).select("row.*")


def keep_learned(docs: DataFrame, network: Network | None, limits: Limits | None) -> DataFrame:
    """The rows of ``docs`` whose text is in a language of the network by ``limits``, columns as given.

    Texts that are null or have no letter go, and all do without a network.
    """

    @F.pandas_udf("boolean")
    def learned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [False] * len(texts)
            at = [i for i, t in enumerate(texts) if t is not None]
            if network is not None and at:
                given = [texts.iloc[i] for i in at]
                for i, t, p in zip(at, given, network.probabilities(given), strict=True):
                    best = int(p.argmax())
                    found[i] = limits.accept(t, network.languages[best], float(p[best]))
            yield pd.Series(found, dtype=bool)

    kept = fresh(docs, "learned")
    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("binary"))
    return docs.withColumn(kept, learned(lettered)).where(F.col(kept)).drop(kept)
