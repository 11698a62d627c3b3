"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is cut into words, and the words into overlapping windows that cover the whole
text. A word enters the network as a word embedding (hashed) beside the mean of the
embeddings of its character 4-grams, so unseen forms of a known stem are recognised.
Two gated recurrent layers read a window in either direction, attention pools their
states, and a logistic unit scores the window. A document scores as its worst window.

The network is written and trained in numpy. Documents are labelled, not windows, so
each epoch trains on the windows that score worst at the time, with a random one of each
clean document beside, and some of a clean word repeated; the first choice goes by the log-odds of words, which are also
the first coordinate of the embeddings to start from. Training runs on the driver on at
most ``train_rows`` rows of each class, of at most ``train_chars`` characters (a sample
in order of a hash of the id); all documents are scored, whole, on the executors. The
network has a fixed size of about a megabyte.

Defined cases: a null text counts as empty; an empty text is one window of padding;
without a labelled row of either class nothing is learnt and every score is 0; ids
labelled twice count as toxic if one label says so; rows that repeat an id are scored
alike; an empty table gives an empty result. Label, language, source and id are no
inputs of a score.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import chunks

WINDOW, STRIDE = 40, 30
WORDS, GRAMS = 1 << 14, 1 << 14
EMBEDDING, STATE, ATTENTION = 8, 8, 8
#: For one in so many clean documents, an epoch also shows one of its words repeated.
DRILL = 2
#: Scores from here on count as toxic.
THRESHOLD = 0.3
PART = 64
_BATCH = 2048
_FLOAT = np.float32


def held_out(id_col: Column) -> Column:
    """Rows that no label is learnt from."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4 == 2


class Lexicon:
    """The distinct words of some texts, as bucket numbers of words and of 4-grams.

    Word 0 is the padding.
    """

    def __init__(self) -> None:
        self.index: defaultdict[str, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.index[""]

    def encode(self, text: str) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, text.lower().split()), np.int32)

    def buckets(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bucket of each word; buckets of all grams, and where each word's begin."""
        words = [word.encode("utf-8", "surrogatepass") for word in self.index]
        word_of = np.array([zlib.crc32(word) % WORDS for word in words])
        framed = [b"^" + word + b"$$" for word in words]
        line = np.frombuffer(b"".join(framed) + b"$$$", np.uint8).astype(np.uint32)
        code = line[:-3] << 24 | line[1:-2] << 16 | line[2:-1] << 8 | line[3:]
        gram_of = (code * np.uint32(2654435761)) >> np.uint32(18)
        sizes = np.array([len(word) for word in framed])
        ends = np.cumsum(sizes)
        inside = np.arange(len(gram_of)) < np.repeat(ends - 3, sizes)
        inside[ends - sizes] = True  # the padding has one gram that counts as any other
        starts = np.cumsum(np.add.reduceat(inside, ends - sizes)) - np.add.reduceat(
            inside, ends - sizes
        )
        return word_of, gram_of[inside], starts


def windows(ids: np.ndarray) -> np.ndarray:
    """Rows of WINDOW words that cover the text; the last one ends with it."""
    if len(ids) < WINDOW:
        return np.pad(ids, (0, WINDOW - len(ids)))[None]
    last = len(ids) - WINDOW
    starts = np.unique(np.append(np.arange(0, last + 1, STRIDE), last))
    return ids[starts[:, None] + np.arange(WINDOW)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Parameters in ``p``; one forward pass for scoring, one with its way back."""

    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(_FLOAT)

        inputs = 2 * EMBEDDING
        self.p = {
            "word": normal(WORDS, EMBEDDING, scale=0.05),
            "gram": normal(GRAMS, EMBEDDING, scale=0.05),
            "attend": normal(2 * STATE, ATTENTION, scale=0.3),
            "query": normal(ATTENTION, scale=0.3),
            "out": normal(2 * STATE, scale=0.3),
            "bias": np.zeros(1, _FLOAT),
        }
        for way in ("ahead", "back"):
            self.p[f"in_{way}"] = normal(inputs, 3 * STATE, scale=inputs**-0.5)
            self.p[f"bias_{way}"] = np.zeros(3 * STATE, _FLOAT)
            self.p[f"state_{way}"] = normal(STATE, 3 * STATE, scale=STATE**-0.5)

    def inputs(self, lexicon_buckets: tuple) -> np.ndarray:
        word_of, gram_of, starts = lexicon_buckets
        counts = np.diff(np.append(starts, len(gram_of)))
        grams = np.add.reduceat(self.p["gram"][gram_of], starts, axis=0) / counts[:, None]
        return np.concatenate([self.p["word"][word_of], grams], axis=1).astype(_FLOAT)

    def _gates(self, x: np.ndarray, way: str) -> np.ndarray:
        return x @ self.p[f"in_{way}"] + self.p[f"bias_{way}"]

    def _read(self, gates: np.ndarray, ids: np.ndarray, way: str, kept: list | None) -> np.ndarray:
        """States after each word, in the order of ``ids`` (a row per word of the window)."""
        state_weights = self.p[f"state_{way}"]
        steps = range(len(ids)) if way == "ahead" else range(len(ids) - 1, -1, -1)
        states = np.empty((*ids.shape, STATE), _FLOAT)
        h = np.zeros((ids.shape[1], STATE), _FLOAT)
        for t in steps:
            given, own = gates[ids[t]], h @ state_weights
            both = _sigmoid(given[:, : 2 * STATE] + own[:, : 2 * STATE])
            reset, keep = both[:, :STATE], both[:, STATE:]
            new = np.tanh(given[:, 2 * STATE :] + reset * own[:, 2 * STATE :])
            if kept is not None:
                kept.append((t, h, reset, keep, new, own[:, 2 * STATE :]))
            h = new + keep * (h - new)
            states[t] = h
        return states

    def _pool(self, states: np.ndarray) -> tuple[np.ndarray, ...]:
        heard = np.tanh(states @ self.p["attend"])
        weight = np.exp(heard @ self.p["query"])
        weight /= weight.sum(0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        return heard, weight, pooled, pooled @ self.p["out"] + self.p["bias"][0]

    def logits(self, gates: dict[str, np.ndarray], ids: np.ndarray) -> np.ndarray:
        """Of windows, a row each, whose words index the rows of ``gates``."""
        found = np.empty(len(ids), _FLOAT)
        for at in range(0, len(ids), _BATCH):
            part = np.ascontiguousarray(ids[at : at + _BATCH].T)
            states = [self._read(gates[way], part, way, None) for way in ("ahead", "back")]
            found[at : at + _BATCH] = self._pool(np.concatenate(states, axis=2))[3]
        return found

    def gates(self, lexicon_buckets: tuple) -> dict[str, np.ndarray]:
        x = self.inputs(lexicon_buckets)
        return {way: self._gates(x, way) for way in ("ahead", "back")}

    def gradients(self, x: np.ndarray, ids: np.ndarray, label: np.ndarray) -> tuple[dict, np.ndarray]:
        """Of the mean logistic loss of some windows; for ``x``, a row per distinct word."""
        ids = np.ascontiguousarray(ids.T)
        gates = {way: self._gates(x, way) for way in ("ahead", "back")}
        kept: dict[str, list] = {"ahead": [], "back": []}
        states = np.concatenate(
            [self._read(gates[way], ids, way, kept[way]) for way in ("ahead", "back")], axis=2
        )
        heard, weight, pooled, logit = self._pool(states)
        d_logit = ((_sigmoid(logit) - label) / len(label)).astype(_FLOAT)
        g = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.p["out"]
        d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        d_states = weight[:, :, None] * d_pooled
        g["query"] = np.einsum("tna,tn->a", heard, d_score)
        d_heard = d_score[:, :, None] * self.p["query"] * (1 - heard**2)
        g["attend"] = np.einsum("tnh,tna->ha", states, d_heard)
        d_states += d_heard @ self.p["attend"].T
        d_x = np.zeros_like(x)
        for number, way in enumerate(("ahead", "back")):
            d_gates = np.zeros_like(gates[way])
            d_own_weights = np.zeros_like(self.p[f"state_{way}"])
            d_h = np.zeros((ids.shape[1], STATE), _FLOAT)
            for t, before, reset, keep, new, own in reversed(kept[way]):
                d_h = d_h + d_states[t][:, number * STATE : (number + 1) * STATE]
                d_new = d_h * (1 - keep) * (1 - new**2)
                d_keep = d_h * (before - new) * keep * (1 - keep)
                d_reset = d_new * own * reset * (1 - reset)
                d_given = np.concatenate([d_reset, d_keep, d_new], axis=1)
                d_own = np.concatenate([d_reset, d_keep, d_new * reset], axis=1)
                np.add.at(d_gates, ids[t], d_given)
                d_own_weights += before.T @ d_own
                d_h = d_h * keep + d_own @ self.p[f"state_{way}"].T
            g[f"state_{way}"] = d_own_weights
            g[f"in_{way}"] = x.T @ d_gates
            g[f"bias_{way}"] = d_gates.sum(0)
            d_x += d_gates @ self.p[f"in_{way}"].T
        return g, d_x


def _log_odds(found: Iterable[np.ndarray], label: np.ndarray, n: int) -> np.ndarray:
    """Of each bucket: how much oftener toxic documents have it; near 0 for rare ones.

    ``found`` has the distinct buckets of each document.
    """
    seen = np.zeros((2, n))
    for buckets, one in zip(found, label, strict=True):
        seen[one, buckets] += 1
    clean, toxic = seen / np.maximum(1, np.bincount(label, minlength=2))[:, None]
    shrink = 4 / len(label)
    return np.log((toxic + shrink) / (clean + shrink))


def _grams_of(words: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of the grams of some words, one word after the other."""
    spans = counts[words]
    return np.repeat(starts[words] - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())


def train(
    texts: list[str], labels: list[int], prior: float, steps: int = 600, seed: int = 7
) -> Network:
    """``prior``: the share of toxic rows among all labelled ones.

    Toxic documents are repeated in an epoch until they are a third as many as clean ones.
    There are at least 8 epochs, and about ``steps`` updates in a small sample.
    """
    rng, network, lexicon = np.random.default_rng(seed), Network(seed), Lexicon()
    label = np.array(labels, np.int64)
    cut = [windows(lexicon.encode(text)) for text in texts]
    buckets = lexicon.buckets()
    word_of, gram_of, starts = buckets
    doc_of = np.repeat(np.arange(len(cut)), [len(w) for w in cut])
    rows = np.concatenate(cut)
    counts = np.diff(np.append(starts, len(gram_of)))
    words = [np.unique(own) for own in cut]
    word_odds = _log_odds(words, label, len(word_of))
    grams = (np.unique(gram_of[_grams_of(own, starts, counts)]) for own in words)
    gram_odds = _log_odds(grams, label, GRAMS)
    hashed = np.zeros(WORDS)
    np.add.at(hashed, word_of, np.where(np.abs(word_odds) > 0.5, word_odds, 0))
    network.p["word"][:, 0] += np.clip(hashed, -2, 4) / 2
    network.p["gram"][:, 0] += np.clip(gram_odds, -2, 4) / 2
    by_grams = np.add.reduceat(gram_odds[gram_of], starts) / counts
    worst = np.maximum(word_odds, by_grams).astype(_FLOAT)[rows].max(1)
    firsts = np.cumsum([0, *[len(own) for own in cut[:-1]]])
    sizes = np.array([len(own) for own in cut])
    del cut, words

    first, second = ({k: np.zeros_like(v) for k, v in network.p.items()} for _ in range(2))
    repeats = max(1, int((label == 0).sum() / (3 * label.sum())))
    shown = np.repeat(np.arange(len(sizes)), np.where(label == 1, repeats, 1))
    epochs = max(8, min(60, steps * PART // (2 * len(shown))))
    step = 0
    for epoch in range(epochs):
        if epoch:
            worst = network.logits(network.gates(buckets), rows)
        order = np.lexsort((-worst, doc_of))
        top = order[firsts]
        random = firsts + rng.integers(0, sizes)
        clean = random[label == 0]
        drill = rows[clean[rng.permutation(len(clean))[: len(clean) // DRILL]]]
        drill = np.repeat(rng.permuted(drill, axis=1)[:, :1], WINDOW, axis=1)
        given = np.concatenate([rows[top[shown]], rows[clean], drill])
        wanted = np.concatenate([label[shown], np.zeros(len(clean) + len(drill))]).astype(_FLOAT)
        chosen = rng.permutation(len(given))
        rate = 0.01 * (1 - epoch / epochs) + 0.001
        for part in np.array_split(chosen, max(1, len(chosen) // PART)):
            used, ids = np.unique(given[part], return_inverse=True)
            own = (
                word_of[used],
                gram_of[_grams_of(used, starts, counts)],
                np.cumsum(counts[used]) - counts[used],
            )
            x = network.inputs(own)
            g, d_x = network.gradients(x, ids.reshape(len(part), WINDOW), wanted[part])
            g["word"] = np.zeros_like(network.p["word"])
            np.add.at(g["word"], own[0], d_x[:, :EMBEDDING])
            g["gram"] = np.zeros_like(network.p["gram"])
            share = d_x[:, EMBEDDING:] / counts[used][:, None]
            np.add.at(g["gram"], own[1], np.repeat(share, counts[used], axis=0))
            step += 1
            for k, value in network.p.items():
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
                scale = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6
                value -= (rate * first[k] / (1 - 0.9**step) / scale).astype(_FLOAT)
    mean = min(max(label[shown].mean(), 1e-3), 1 - 1e-3)
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    shift = np.log(prior / (1 - prior)) - np.log(mean / (1 - mean))
    network.p["bias"] += _FLOAT(shift)
    return network


def worst_windows(network: Network, texts: list[str]) -> np.ndarray:
    """The score of each text."""
    lexicon = Lexicon()
    cut = [windows(lexicon.encode(text)) for text in texts]
    gates = network.gates(lexicon.buckets())
    logit = network.logits(gates, np.concatenate(cut))
    starts = np.cumsum([0, *[len(w) for w in cut[:-1]]])
    return _sigmoid(np.maximum.reduceat(logit, starts).astype(np.float64))


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int,
    train_chars: int,
    id_col: str,
    text_col: str,
    label_col: str,
) -> tuple[list[str], list[int], float]:
    """A bounded sample of each class, and the share of toxic rows among all labelled.

    The ids are chosen first; at most ``2 * train_rows`` of them are then broadcast.
    """
    usable = (
        labels.filter(F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max((F.col(label_col) > 0).cast("int")).alias("_label"))
    )
    counts = {row["_label"]: row["n"] for row in usable.groupBy("_label").agg(
        F.count("*").alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return [], [], 0.0
    order = F.xxhash64("_id", F.lit(11))
    picked = [
        usable.filter(F.col("_label") == one).orderBy(order, "_id").limit(train_rows)
        for one in (0, 1)
    ]
    picked = picked[0].unionByName(picked[1])
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = (
        texts.filter(F.length("_text") <= train_chars)
        .join(F.broadcast(picked), "_id")
        .orderBy("_id", "_text")
        .limit(2 * train_rows)
        .collect()
    )
    return (
        [row["_text"] for row in rows],
        [row["_label"] for row in rows],
        counts[1] / (counts[0] + counts[1]),
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = 1500,
    train_chars: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Network | None:
    """The trained network, or None if there are not labelled rows of both classes."""
    texts, labelled, prior = training_rows(
        docs, labels, train_rows, train_chars, id_col, text_col, label_col
    )
    return train(texts, labelled, prior) if len(set(labelled)) == 2 else None


def scorer(network: Network | None, text_at: int) -> Callable:
    """A batch function that appends the score of column ``text_at`` as the last column."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at)
            for start, end in chunks(texts, 1 << 21):
                part = batch.slice(start, end - start)
                given = [text or "" for text in part.column(text_at).to_pylist()]
                scores = np.zeros(len(given)) if network is None else worst_windows(network, given)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(scores, pa.float64())],
                    [*part.schema.names, "score"],
                )

    return score


def _with_score(docs: DataFrame) -> T.StructType:
    return T.StructType([*docs.schema, T.StructField("score", T.DoubleType())])


def scores(
    docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, score`` per row; each text is read where it lies, nothing is shuffled."""
    given = docs.select(id_col, F.col(text_col).alias("_text"))
    scored = given.mapInArrow(scorer(network, 1), _with_score(given))
    return scored.drop("_text")


def clean_documents(
    docs: DataFrame, network: Network | None, threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, columns as given."""
    columns = [F.col(f"`{name}`").alias(f"c{n}") for n, name in enumerate(docs.columns)]
    plain = docs.select(*columns)
    scored = plain.mapInArrow(
        scorer(network, docs.columns.index(text_col)), _with_score(plain)
    )
    kept = scored.filter(F.col("score") < threshold)
    return kept.select(*[F.col(f"c{n}").alias(name) for n, name in enumerate(docs.columns)])
