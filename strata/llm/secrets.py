"""Secrets in texts: fixed rules, and a character convolutional network over candidates.

The rules find assignments to telling names, access key ids and long hex strings. A
candidate is any other run of at least ``LEAST`` token characters, whatever it is made of:
words, numbers, paths and keys alike go to the network, which alone decides. It sees a
candidate with the characters around it: characters are embedded, convolved, and pooled by
maximum over the context before, the candidate and the context after. A candidate longer
than a frame is seen in overlapping frames and scores as the highest.

Training uses labelled findings: in a bounded sample of documents (``train_docs``, in order
of a hash of the id) what the rules find is secret, and other runs, at most ``train_runs``,
are not; made-up keys, and made-up mail addresses, numbers, paths and the like, are set into
contexts of the sample besides. Every fifth finding, with all its frames, is kept out of
training. On these the scores are calibrated by a logistic fit, and the threshold is the
highest that keeps the wanted recall, where a key that is no candidate counts as missed.
Candidates from the threshold up are added to the findings of the rules, which all stay.

Spans are in code points, end exclusive. Texts are read whole where they lie; nothing is
shuffled. The network has a few kilobytes.

Defined cases: a null text counts as empty and has no findings; rows that repeat an id
are read each; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import chunks

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Parts of the names, in lower case; a text without any has no assignment.
_NAMES = ("passw", "secret", "token", "api")
LEAST = 12
#: Characters of a frame: context, candidate, context.
CONTEXT, INNER = 24, 48
FRAME = CONTEXT + INNER + CONTEXT
EMBEDDING, WIDTH, FILTERS = 8, 5, 24
_FLOAT = np.float32

_TOKEN = np.zeros(128, bool)
_TOKEN[[ord(c) for c in string.ascii_letters + string.digits + "+/_=-."]] = True
#: Frames that are scored at a time.
_FRAMES = 4096

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def rule_spans(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    """What the rules find. ``runs``: the runs of at least ``LEAST`` token characters."""
    found: list[Span] = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    for start, end in runs:
        if end - start >= 32:  # a hex string lies inside a run of token characters
            for m in HEX.finditer(text, start, end):
                if m.end() - m.start() >= 32:
                    found.append((m.start(), 2, m.end()))
    return sorted(found)


def token_runs(texts: list[str]) -> list[list[tuple[int, int]]]:
    """Start and end of the long runs of each text; full stops around a run are not of it."""
    line = "\n".join(texts)
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
    small = np.minimum(codes, 127).astype(np.uint8)
    token = np.concatenate([[False], _TOKEN[small] & (codes < 127), [False]])
    edges = np.flatnonzero(token[1:] != token[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= LEAST
    starts, ends = starts[long], ends[long]
    begins = np.cumsum([0, *[len(text) + 1 for text in texts]])
    which = np.searchsorted(begins, starts, "right") - 1
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    for n, start, end in zip(which.tolist(), starts.tolist(), ends.tolist(), strict=True):
        run = line[start:end]
        inner = run.strip(".")
        if len(inner) >= LEAST:
            at = start + run.index(inner) - int(begins[n])
            found[n].append((at, at + len(inner)))
    return found


def candidates(runs: list[tuple[int, int]], spans: list[Span]) -> list[tuple[int, int]]:
    """The runs that meet no span; both are in order of their starts."""
    kept, at, reached = [], 0, -1
    for start, end in runs:
        while at < len(spans) and spans[at][0] < end:
            reached = max(reached, spans[at][2])
            at += 1
        if reached <= start:
            kept.append((start, end))
    return kept


def frames(text: str, start: int, end: int) -> Iterator[np.ndarray]:
    """Frames of a span: rows of character numbers, of part numbers (0, 1, 2), 3 for none."""
    at = start
    while True:
        stop = min(end, at + INNER)
        parts = (text[max(0, at - CONTEXT) : at], text[at:stop], text[stop : stop + CONTEXT])
        line, part = "".join(parts), np.repeat([0, 1, 2], [len(p) for p in parts])
        frame = np.zeros((2, FRAME), np.uint8)
        frame[1] = 3
        codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
        frame[0, : len(line)] = np.minimum(codes, 127)
        frame[1, : len(line)] = part
        yield frame
        if stop == end:
            return
        at += INNER // 2


class Network:
    """Embedding, convolution, maximum over each part, logistic unit."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.p = {
            "embed": (rng.standard_normal((128, EMBEDDING)) * 0.3).astype(_FLOAT),
            "filter": (rng.standard_normal((WIDTH * EMBEDDING, FILTERS)) * 0.15).astype(_FLOAT),
            "filter_bias": np.zeros(FILTERS, _FLOAT),
            "out": (rng.standard_normal(3 * FILTERS) * 0.2).astype(_FLOAT),
            "bias": np.zeros(1, _FLOAT),
        }

    def forward(self, given: np.ndarray) -> tuple:
        codes, part = given[:, 0], given[:, 1]
        x = self.p["embed"][codes]
        padded = np.pad(x, ((0, 0), (WIDTH // 2, WIDTH // 2), (0, 0)))
        patches = np.lib.stride_tricks.sliding_window_view(padded, WIDTH, axis=1)
        patches = patches.transpose(0, 1, 3, 2).reshape(len(given), FRAME, -1)
        heard = np.maximum(patches @ self.p["filter"] + self.p["filter_bias"], 0)
        pooled, at = [], []
        for n in range(3):
            inside = np.where((part == n)[:, :, None], heard, 0)
            at.append(inside.argmax(1))
            pooled.append(np.take_along_axis(inside, at[-1][:, None], 1)[:, 0])
        features = np.concatenate(pooled, axis=1)
        return patches, features, at, features @ self.p["out"] + self.p["bias"][0]

    def logits(self, given: np.ndarray) -> np.ndarray:
        parts = [self.forward(given[n : n + 512])[3] for n in range(0, len(given), 512)]
        return np.concatenate(parts) if parts else np.empty(0, _FLOAT)

    def gradients(self, given: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        patches, features, at, logit = self.forward(given)
        d = ((1 / (1 + np.exp(-logit)) - label) / len(label)).astype(_FLOAT)
        g = {"out": features.T @ d, "bias": d.sum(keepdims=True)}
        d_features = d[:, None] * self.p["out"] * (features > 0)
        d_patches = np.zeros_like(patches)
        d_filter, d_bias = np.zeros_like(self.p["filter"]), np.zeros(FILTERS, _FLOAT)
        rows = np.arange(len(given))[:, None]
        for n in range(3):
            d_heard = np.zeros((len(given), FRAME, FILTERS), _FLOAT)
            d_heard[rows, at[n], np.arange(FILTERS)] = d_features[
                :, n * FILTERS : (n + 1) * FILTERS
            ]
            d_filter += np.einsum("ntp,ntf->pf", patches, d_heard, optimize=True)
            d_bias += d_heard.sum((0, 1))
            d_patches += d_heard @ self.p["filter"].T
        g["filter"], g["filter_bias"] = d_filter, d_bias
        d_patches = d_patches.reshape(len(given), FRAME, WIDTH, EMBEDDING)
        d_x = np.zeros((len(given), FRAME, EMBEDDING), d_patches.dtype)
        for k in range(WIDTH):
            shift = k - WIDTH // 2
            to = slice(max(0, shift), FRAME + min(0, shift))
            of = slice(max(0, -shift), FRAME + min(0, -shift))
            d_x[:, to] += d_patches[:, of, k]
        codes, flat = given[:, 0].ravel(), d_x.reshape(-1, EMBEDDING)
        columns = [np.bincount(codes, flat[:, n], minlength=128) for n in range(EMBEDDING)]
        g["embed"] = np.stack(columns, axis=1).astype(d_patches.dtype)
        return g


@dataclass
class Model:
    network: Network
    slope: float
    offset: float
    threshold: float

    def probability(self, logit: np.ndarray) -> np.ndarray:
        known = np.isfinite(logit)
        x = self.slope * np.where(known, logit, 0).astype(np.float64) + self.offset
        return np.where(known, 1 / (1 + np.exp(-np.clip(x, -700, 700))), 0.0)

    def probabilities(self, given: np.ndarray) -> np.ndarray:
        return self.probability(self.network.logits(given))


def calibrate(logit: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit, by Newton steps with a small ridge.

    Labels are taken as a little less than sure, the less the more there are of them, so
    that classes which come apart still get probabilities short of 0 and 1.
    """
    positive = label.sum()
    label = np.where(label == 1, (positive + 1) / (positive + 2), 1 / (len(label) - positive + 2))
    x = np.stack([logit, np.ones_like(logit)], axis=1).astype(np.float64)
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - label) + 0.1 * (w - [1.0, 0.0])
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        change = np.linalg.solve(bend, slope)
        w = w - change / max(1.0, float(np.abs(change).max()) / 0.25)
    return float(w[0]), float(w[1])


def recall_threshold(probability: np.ndarray, label: np.ndarray, recall: float) -> float:
    """The highest threshold that finds a share of at least ``recall`` of the positives."""
    positive = np.sort(probability[label == 1])
    return float(positive[int((1 - recall) * len(positive))]) if len(positive) else 1.0


#: Frames of one finding, none if it is no candidate, and whether it is a secret.
Finding = tuple[list[np.ndarray], int]


def highest(model: Network, findings: list[Finding]) -> np.ndarray:
    """The highest logit of each finding's frames; minus infinity without any."""
    sizes = [len(own) for own, _ in findings]
    given = [frame for own, _ in findings for frame in own]
    logits = model.logits(np.stack(given)) if given else np.empty(0)
    ends = np.cumsum([0, *sizes])
    best = [logits[a:b].max() if b > a else -np.inf for a, b in zip(ends, ends[1:], strict=False)]
    return np.array(best, np.float64)


def train(
    findings: list[Finding], recall: float = 0.95, epochs: int = 12, seed: int = 3
) -> Model:
    """Every fifth finding serves calibration and the threshold."""
    rng, network = np.random.default_rng(seed), Network(seed)
    order = rng.permutation(len(findings))
    kept = [findings[n] for n in order[::5]]
    learnt = [
        (frame, label)
        for n in np.delete(order, np.s_[::5])
        for frame in findings[n][0]
        for label in [findings[n][1]]
    ]
    given = np.stack([frame for frame, _ in learnt])
    label = np.array([one for _, one in learnt], _FLOAT)
    places = np.arange(len(given))
    first, second = ({k: np.zeros_like(v) for k, v in network.p.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        rng.shuffle(places)
        for part in np.array_split(places, max(1, len(places) // 64)):
            g = network.gradients(given[part], label[part])
            step += 1
            for k, value in network.p.items():
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
                scale = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6
                value -= (0.005 * first[k] / (1 - 0.9**step) / scale).astype(_FLOAT)
    logit, truth = highest(network, kept), np.array([one for _, one in kept])
    seen = np.isfinite(logit)
    slope, offset = calibrate(logit[seen], truth[seen])
    model = Model(network, slope, offset, 1.0)
    model.threshold = recall_threshold(model.probability(logit), truth, recall)
    return model


def made_up(rng: random.Random, secret: bool) -> str:
    """A key, or a string that looks like one and is none."""

    def some(letters: str, least: int, most: int) -> str:
        return "".join(rng.choices(letters, k=rng.randint(least, most)))

    alnum = string.ascii_letters + string.digits
    if secret:
        return rng.choice(
            [
                lambda: some(string.hexdigits.lower()[:16], 20, 64),
                lambda: some(alnum, 12, 44),
                lambda: some(alnum, 12, 20),
                lambda: some(string.ascii_letters, 20, 40),
                lambda: some(string.ascii_lowercase, 20, 40),
                lambda: some(string.ascii_lowercase, 20, 26),
                lambda: "-".join(some(string.digits, 8, 12) for _ in range(2)) + "-" + some(alnum, 16, 32),
                lambda: some(alnum + "_-", 20, 44),
                lambda: ".".join(some(alnum + "_-", 12, 40) for _ in range(3)),
                lambda: some(alnum + "+/", 40, 88) + rng.choice(["", "=", "=="]),
                lambda: some(string.ascii_lowercase, 2, 4) + "_" + some(alnum, 24, 40),
                lambda: some(string.ascii_uppercase, 4, 4)
                + some(string.ascii_uppercase + string.digits, 12, 16),
            ]
        )()
    lower = string.ascii_lowercase
    return rng.choice(
        [
            lambda: some(lower, 10, 20) + some(string.digits, 1, 4),
            lambda: some(lower, 4, 9) + "." + some(string.digits, 2, 2) + "@mail.example.com",
            lambda: "-".join(some(string.digits, 2, 4) for _ in range(5)) + some(lower, 1, 1),
            lambda: "/".join(some(lower, 3, 9) for _ in range(4)) + "/" + some(string.digits, 1, 6),
            lambda: "-".join(some(lower, 3, 9) for _ in range(4)) + "-" + some(string.digits, 1, 4),
            lambda: "_".join(some(lower, 3, 9) for _ in range(3)) + some(string.digits, 1, 2),
            lambda: some(string.digits, 4, 4) + "-" + some(string.digits, 2, 2) + "T"
            + some(string.digits, 6, 9),
        ]
    )()


def labelled_findings(
    texts: list[str], made: int, seed: int = 3, train_runs: int = 6000
) -> list[Finding]:
    """From the texts by the rules, and ``made`` of each class set into them."""
    rng, found, passed = random.Random(seed), [], []
    for text, runs in zip(texts, token_runs(texts), strict=True):
        spans = rule_spans(text, runs)
        found += [(list(frames(text, start, end)), 1) for start, _, end in spans]
        passed += [(text, run) for run in candidates(runs, spans)]
    if len(passed) > train_runs:
        passed = rng.sample(passed, train_runs)
    found += [(list(frames(text, *run)), 0) for text, run in passed]
    places = [text for text in texts if text] or [" "]
    for n in range(2 * made):
        text, secret = rng.choice(places), n % 2 == 0
        at = rng.randrange(len(text))
        at = text.rfind(" ", 0, at) + 1
        given = made_up(rng, secret)
        line = text[max(0, at - 40) : at] + given + " " + text[at : at + 40]
        begin = min(40, at)
        found.append((candidate_frames(line, begin, begin + len(given)), int(secret)))
    return found


def candidate_frames(text: str, start: int, end: int) -> list[np.ndarray]:
    """Frames of all runs that meet a span; none if the network would not see it."""
    runs = [run for run in token_runs([text])[0] if run[0] < end and start < run[1]]
    return [frame for run in runs for frame in frames(text, *run)]


def fit(
    docs: DataFrame,
    train_docs: int = 1500,
    train_chars: int = 20_000,
    train_runs: int = 6000,
    made: int = 2500,
    recall: float = 0.98,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """Train on at most ``train_docs`` documents; their ids are chosen, then broadcast."""
    ids = docs.select(F.col(id_col).alias("_id")).filter("_id IS NOT NULL").distinct()
    picked = ids.orderBy(F.xxhash64("_id", F.lit(23)), "_id").limit(train_docs)
    rows = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .filter(F.length("_text") <= train_chars)
        .join(F.broadcast(picked), "_id")
        .orderBy("_id", "_text")
        .limit(train_docs)
        .collect()
    )
    texts = [row["_text"] for row in rows]
    return train(labelled_findings(texts, made, train_runs=train_runs), recall)


def scan(texts: list[str], model: Model) -> list[list[tuple[Span, float]]]:
    """All findings of each text by start and kind, with their probability.

    Frames are made and scored some thousands at a time, however many a text has.
    """
    found: list[list[tuple[Span, float]]] = [[] for _ in texts]
    best: dict[tuple[int, Span], float] = {}
    given, where = [], []

    def score() -> None:
        if given:
            probability = model.probabilities(np.stack(given)).tolist()
            for key, value in zip(where, probability, strict=True):
                best[key] = max(best.get(key, 0.0), value)
        given.clear()
        where.clear()

    for n, (text, runs) in enumerate(zip(texts, token_runs(texts), strict=True)):
        spans = rule_spans(text, runs)
        for span in [*spans, *[(a, 3, b) for a, b in candidates(runs, spans)]]:
            for frame in frames(text, span[0], span[2]):
                given.append(frame)
                where.append((n, span))
                if len(given) >= _FRAMES:
                    score()
    score()
    for (n, span), probability in best.items():
        if span[1] < 3 or probability >= model.threshold:
            found[n].append((span, probability))
    return [sorted(spans) for spans in found]


FINDING = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("probability", T.DoubleType()),
        ]
    )
)


def findings(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, findings (kind, start, end, probability; by start, then kind)."""
    given = docs.select(id_col, F.col(text_col).alias("_text"))
    kind = pa.list_(
        pa.struct(
            [
                ("kind", pa.string()),
                ("start", pa.int64()),
                ("end", pa.int64()),
                ("probability", pa.float64()),
            ]
        )
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in chunks(batch.column(1), 1 << 20):
                part = batch.slice(start, end - start)
                texts = [text or "" for text in part.column(1).to_pylist()]
                rows = [
                    [
                        {"kind": KINDS[k], "start": a, "end": b, "probability": p}
                        for (a, k, b), p in row
                    ]
                    for row in scan(texts, model)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(rows, kind)], [id_col, "findings"]
                )

    return given.mapInArrow(
        compute, T.StructType([given.schema[id_col], T.StructField("findings", FINDING)])
    )

