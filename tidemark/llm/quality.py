"""Quality classifier: a linear-chain CRF over the lines of a document.

Each line is good (1) or bad (0). Its features are shares of character classes,
repeated words and the like, together with those of the lines before and after.
Forward-backward gives each line's marginal; their mean, weighted by length, is
put on the scale of the document labels by a logistic curve.

Only documents have labels. Lines of good documents are taken as good; lines of
bad ones start as bad, and after each round those that the chain finds good are
relabelled, but never all of a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, give_back, tidy

#: Characters that numpy works on at once (some 50 bytes each); a longer text is a chunk of its own.
CHUNK_CHARS = 1 << 18
#: The character classes.
_SYMBOLS, _MARKS = "#*$%&|<>", ".,;:?"
(OTHER, LOWER, UPPER, DIGIT, SPACE, SYMBOL, BANG, MARK) = range(8)
_CLASS: np.ndarray | None = None
N_FEATURES = 11


def _classes() -> np.ndarray:
    """The class of each character of the basic plane; beyond it all are OTHER."""
    global _CLASS
    if _CLASS is None:
        table = np.zeros(1 << 16, np.uint8)
        for k in range(1 << 16):
            c = chr(k)
            table[k] = SYMBOL if c in _SYMBOLS else MARK if c in _MARKS else BANG if c == "!" else SPACE if c.isspace() else DIGIT if c.isdigit() else UPPER if c.isupper() else LOWER if c.isalpha() else OTHER
        _CLASS = table
    return _CLASS


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of these texts, their lengths, and each text's number of lines."""
    code = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(code == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    lengths = ends - starts
    n = len(ends)
    doc_ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    lines = np.diff(np.searchsorted(ends, doc_ends - 1, side="right"), prepend=0)
    doc = np.repeat(np.arange(len(texts)), lines)

    kind = np.where(code < 1 << 16, _classes()[np.minimum(code, (1 << 16) - 1)], OTHER)
    line = np.repeat(np.arange(n), lengths + 1)
    counts = np.bincount(line * 8 + kind, minlength=8 * n).reshape(n, 8).astype(np.float32)
    counts[:, SPACE] -= 1  # the line's end

    solid = kind != SPACE
    first = solid & np.concatenate([[True], ~solid[:-1]])
    at = np.flatnonzero(first)
    words = np.bincount(line[at], minlength=n).astype(np.float32)
    same, whole = np.zeros(n, np.float32), np.zeros(n, np.uint64)
    if len(at):
        opens = at if at[0] == 0 else np.concatenate([[0], at])
        place = np.arange(len(code)) - np.repeat(opens, np.diff(opens, append=len(code)))
        mixed = (code.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 63] * solid
        hashes = np.add.reduceat(mixed, at)
        again = (hashes[1:] == hashes[:-1]) & (line[at[1:]] == line[at[:-1]])
        same = np.bincount(line[at[1:]][again], minlength=n).astype(np.float32)
        per_line = np.bincount(line[at], minlength=n)
        rank = np.arange(len(at)) - np.repeat(np.cumsum(per_line) - per_line, per_line)
        np.add.at(whole, line[at], hashes * _POWERS[rank & 63])
    # A line that an earlier line of its text equals, by a hash of its words.
    order = np.lexsort((np.arange(n), whole, doc))
    twin = (whole[order][1:] == whole[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    dup = np.zeros(n, np.float32)
    dup[order[1:][twin]] = 1
    dup[words == 0] = 0

    size = np.maximum(lengths, 1).astype(np.float32)
    letters = np.maximum(counts[:, LOWER] + counts[:, UPPER], 1)
    some = np.maximum(words, 1)
    features = np.stack(
        [
            np.log1p(lengths) / 5,
            counts[:, UPPER] / letters,
            4 * counts[:, SYMBOL] / size,
            4 * counts[:, BANG] / size,
            counts[:, DIGIT] / size,
            4 * counts[:, MARK] / size,
            counts[:, OTHER] / size,
            same / some,
            (size - counts[:, SPACE]) / some / 10,
            dup,
            words == 0,
        ],
        axis=1,
    ).astype(np.float32)
    return features, lengths.astype(np.int64), lines


_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def with_neighbours(features: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """A line's own features, those of the lines before and after, two marks of an edge, one."""
    n = len(features)
    ends = np.cumsum(lines)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[ends - lines], last[ends - 1] = True, True
    before = np.where(first[:, None], 0, np.roll(features, 1, axis=0))
    after = np.where(last[:, None], 0, np.roll(features, -1, axis=0))
    return np.concatenate([features, before, after, first[:, None], last[:, None], np.ones((n, 1))], axis=1).astype(np.float32)


class _Steps:
    """Positions of all lines, by step along the chains: longest chains first."""

    def __init__(self, lines: np.ndarray) -> None:
        order = np.argsort(-lines, kind="stable")
        starts = (np.cumsum(lines) - lines)[order]
        alive = np.searchsorted(-lines[order], -np.arange(lines.max(initial=0)), side="left")
        self.at = [starts[:k] + t for t, k in enumerate(alive)]


def marginals(score: np.ndarray, trans: np.ndarray, steps: _Steps) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each line's probability of good, and the forward and backward log-odds.

    score: log-odds of good by the line's own features; trans[i, j]: weight of
    state i followed by state j.
    """
    ahead, back = score.astype(np.float64).copy(), np.zeros(len(score))
    for t in range(1, len(steps.at)):
        now = steps.at[t]
        r = ahead[now - 1]
        ahead[now] += np.logaddexp(trans[0, 1], r + trans[1, 1]) - np.logaddexp(trans[0, 0], r + trans[1, 0])
    for t in range(len(steps.at) - 1, 0, -1):
        now = steps.at[t]
        b = score[now] + back[now]
        back[now - 1] = np.logaddexp(trans[1, 0], trans[1, 1] + b) - np.logaddexp(trans[0, 0], trans[0, 1] + b)
    return 1 / (1 + np.exp(-np.clip(ahead + back, -50, 50))), ahead, back


@dataclass
class Model:
    weights: np.ndarray
    trans: np.ndarray
    scale: float
    shift: float

    def line_scores(self, features: np.ndarray, lines: np.ndarray) -> np.ndarray:
        score = with_neighbours(features, lines) @ self.weights
        return marginals(score, self.trans, _Steps(lines))[0]

    def raw(self, features: np.ndarray, lengths: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Length-weighted mean marginal of each document, in log-odds."""
        p = self.line_scores(features, lines)
        starts = np.cumsum(lines) - lines
        weight = lengths + 1.0
        mean = np.add.reduceat(p * weight, starts) / np.add.reduceat(weight, starts)
        mean = np.clip(mean, 1e-3, 1 - 1e-3)
        return np.log(mean / (1 - mean))

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        return 1 / (1 + np.exp(-(self.scale * self.raw(*line_features(texts)) + self.shift)))


def _train_chain(x: np.ndarray, y: np.ndarray, lines: np.ndarray, weight: np.ndarray, weights: np.ndarray, trans: np.ndarray, rounds: int, decay: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient ascent (Adam) on the chains' likelihood of the line labels y."""
    steps = _Steps(lines)
    inner = np.concatenate(steps.at[1:]) if len(steps.at) > 1 else np.empty(0, np.int64)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner - 1], y[inner]), weight[inner])
    total = weight.sum()
    m, v = np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)
    theta = np.concatenate([weights, trans.ravel()])
    for k in range(1, rounds + 1):
        weights, trans = theta[:-4], theta[-4:].reshape(2, 2)
        score = x @ weights
        p, ahead, back = marginals(score, trans, steps)
        grad = x.T @ ((y - p) * weight)
        pair = np.zeros((2, 2))
        if len(inner):
            e = np.stack([i * ahead[inner - 1] + trans[i, j] + j * (score[inner] + back[inner]) for i in (0, 1) for j in (0, 1)])
            e = np.exp(e - e.max(axis=0))
            pair = (e / e.sum(axis=0) @ weight[inner]).reshape(2, 2)
        g = np.concatenate([grad, (seen - pair).ravel()]) / total - decay * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def train(features: np.ndarray, lengths: np.ndarray, lines: np.ndarray, label: np.ndarray, weight: np.ndarray, piece: int = 64, rounds: tuple[int, ...] = (120, 60, 60), decay: float = 1e-3) -> Model:
    """Fit chain and curve to documents (label 0 or 1, weight) given by their lines.

    Chains longer than ``piece`` lines are trained as several. Without documents
    of both labels every score is the smoothed share of label 1.
    """
    if len(set(label.tolist())) < 2:
        share = (label.sum() + 1) / (len(label) + 2)
        return Model(np.zeros(3 * N_FEATURES + 3), np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    x = with_neighbours(features, lines)
    pieces = np.concatenate([np.full(-(-k // piece), piece) for k in lines])
    last = np.cumsum(-(-lines // piece)) - 1
    pieces[last] = lines - (-(-lines // piece) - 1) * piece
    doc = np.repeat(np.arange(len(lines)), lines)
    # Each document weighs the same per label, spread over its lines by length.
    each = np.where(label == 1, 0.5 / (label == 1).sum(), 0.5 / (label == 0).sum())
    spread = (lengths + 1.0) / np.bincount(doc, lengths + 1.0)[doc]
    line_weight = each[doc] * spread
    y = label[doc].astype(np.int64)
    model = Model(np.zeros(x.shape[1]), np.zeros((2, 2)), 1.0, 0.0)
    starts = np.cumsum(lines) - lines
    for k, n in enumerate(rounds):
        if k:
            p = model.line_scores(features, lines)
            worst = p == np.repeat(np.minimum.reduceat(p, starts), lines)
            y = np.where((label[doc] == 0) & (worst | (p < 0.8)), 0, 1)
        model.weights, model.trans = _train_chain(x, y, pieces, line_weight, model.weights, model.trans, n, decay)
    raw = model.raw(features, lengths, lines)
    theta = np.array([1.0, 0.0])  # Newton's method on the weighted logistic likelihood
    z = np.stack([raw, np.ones(len(raw))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        g = z.T @ (weight * (label - p)) - 0.1 * theta
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(2)
        theta = theta + np.clip(np.linalg.solve(h, g), -2, 2)
    model.scale, model.shift = float(theta[0]), float(theta[1])
    return model


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > CHUNK_CHARS:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    """The scores of these texts, of which a few hundred are Python strings at a time."""
    got = [np.empty(0)]
    for k in range(0, len(texts), 256):
        got += [model.scores(part) for part in _chunks([t or "" for t in texts.slice(k, 256).to_pylist()])]
    return np.concatenate(got)


def held_out(id_col: str, folds: int = 5, fold: int = 0):
    """Whether crc32 of the id as text leaves this remainder; null ids are held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_docs: int = 1500, max_lines: int = 2000) -> Model:
    """Fit on at most ``max_docs`` documents of either label that are not held out.

    The bounded sample takes those whose text has the least hash, and learns from
    at most ``max_lines`` lines of each, those around its middle. Rows with a
    null id, text or label teach nothing.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1)).distinct()
    usable = docs.where(~held_out(id_col) & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"))
    both = cut(usable.join(known, "id"))
    share = {r.label: r["n"] for r in both.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = [(r.id, r.label) for k in (0, 1) for r in both.where(F.col("label") == k).orderBy("h", "id").limit(max_docs).collect()]
    if len(share) < 2:
        label = np.array([k for k, n in share.items() for _ in range(min(n, max_docs))], np.int64)
        return train(np.empty((0, N_FEATURES)), np.empty(0), np.empty(0, np.int64), label, np.ones(len(label)))
    ids = spark.createDataFrame(chosen, both.select("id", "label").schema)  # two times max_docs rows
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull()).join(F.broadcast(ids), "id").select("text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
                features, lengths, _ = line_features([text.as_py()])
                skip = max(0, len(lengths) - max_lines) // 2
                features, lengths = features[skip : skip + max_lines], lengths[skip : skip + max_lines]
                yield pa.record_batch([pa.array([features.tobytes()]), pa.array([lengths.tobytes()]), pa.array([len(lengths)], pa.int64()), pa.array([label], pa.int64())], ["f", "n", "k", "y"])

    rows = given.mapInArrow(tidy(run), "f binary, n binary, k bigint, y bigint").collect()
    features = np.concatenate([np.frombuffer(r.f, np.float32) for r in rows]).reshape(-1, N_FEATURES)
    lengths = np.concatenate([np.frombuffer(r.n, np.int64) for r in rows])
    lines, label = (np.array([r[c] for r in rows], np.int64) for c in "ky")
    # The sample has as many of either label as it can; weights restore their shares.
    n = np.bincount(label, minlength=2)
    total = share[0] + share[1]
    weight = np.where(label == 1, share[1] / total / max(n[1], 1), share[0] / total / max(n[0], 1)) * len(label)
    model = train(features, lengths, lines, label, weight)
    del rows, features
    give_back()
    return model


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, score): the probability of label 1 for each whole text.

    Null and empty texts are scored as one empty line. Rows are kept as they
    are, repeated ones and null ids too; other columns are left out. An empty
    table gives an empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column("id"), pa.array(_scores(model, batch.column("text")), pa.float64())], ["id", "score"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    got = given.mapInArrow(tidy(run), f"id {kind}, score double").withColumnRenamed("id", id_col)
    return got.select(id_col, held_out(id_col).alias("held_out"), "score")


def good(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, all columns kept.

    Null and empty texts are scored as one empty line; repeated rows are judged
    alike. An empty table gives an empty one. Only texts go to Python, and only
    scores come back.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return (pa.array(_scores(model, batch), pa.float64()) for batch in batches)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from tidy(run)(batches)

    return docs.where(score(F.col(text_col).cast("string")) >= least)
