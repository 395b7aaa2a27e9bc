"""Toxicity by a convolutional text classifier: hashed word embeddings, filters of several widths, max pooling."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import least_by_hash
from .text_arrays import Words
from .tokens import slices

# Common short words that tell a text's language; a text without any is "other".
LANGUAGE_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "by", "this", "are"),
    "de": ("der", "die", "und", "das", "ist", "von", "mit", "den", "dem", "ein", "nicht", "zu", "auf", "im"),
    "fr": ("le", "les", "et", "des", "est", "une", "du", "dans", "que", "pour", "qui", "au", "pas", "sur"),
    "es": ("el", "los", "y", "que", "por", "con", "las", "una", "su", "para", "es", "lo", "no", "del"),
}
LANGUAGES = (*LANGUAGE_WORDS, "other")
PREFIXES = (4, 5, 6)
# Bounds of the training sample: rows of each label, and the longest text in it.
SAMPLE_ROWS = 3_000
SAMPLE_BYTES = 20_000


@dataclass
class Settings:
    buckets: int = 1 << 18
    dimension: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    epochs: int = 12
    batch: int = 64
    rate: float = 0.03
    seed: int = 7


class Texts:
    """Bucket numbers of a run of texts: one row a word (itself and its prefixes), with blanks before each text, so that
    no window reaches from one text into another."""

    def __init__(self, column: pa.Array, settings: Settings):
        words = Words(column, lower=True, runs=True)
        letters = words.kind == 1
        # Bucket 0 is the blank between texts.
        ids = np.stack(
            [1 + ((h + np.uint64(k)) % np.uint64(settings.buckets - 1)).astype(np.int64) for k, h in enumerate(words.hashes(*PREFIXES))], axis=1
        )[letters]
        kept = np.append(0, np.cumsum(letters))[words.first]
        gap = max(settings.widths)
        n = np.diff(kept)
        self.first = np.append(0, np.cumsum(n + gap))
        self.ids = np.zeros((int(self.first[-1]), ids.shape[1]), np.int64)
        self.ids[np.arange(len(ids)) + gap * np.repeat(np.arange(1, len(n) + 1), n)] = ids
        self.language = _languages(words, len(n))


def _language_hashes() -> tuple[np.ndarray, np.ndarray]:
    words, langs = zip(*[(w, i) for i, ws in enumerate(LANGUAGE_WORDS.values()) for w in ws])
    hashes = Words(pa.array(words), lower=True, runs=True).hashes()
    order = np.argsort(hashes, kind="stable")
    return hashes[order], np.array(langs)[order]


def _languages(words: Words, texts: int) -> np.ndarray:
    """The language whose common words a text has most of, from the text alone."""
    known, langs = _language_hashes()
    hashes = words.hashes()
    votes = np.zeros((texts, len(LANGUAGES)))
    text = np.repeat(np.arange(texts), np.diff(words.first))
    for side in ("left", "right"):  # a word of two languages votes for both
        at = np.searchsorted(known, hashes, side=side) - (side == "right")
        at = np.clip(at, 0, len(known) - 1)
        hit = known[at] == hashes
        votes += np.bincount(text[hit] * len(LANGUAGES) + langs[at[hit]], minlength=texts * len(LANGUAGES)).reshape(texts, -1)
    votes[:, -1] = 0.5
    return votes.argmax(axis=1)


@dataclass
class Model:
    settings: Settings
    embeddings: np.ndarray
    kernels: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))

    @classmethod
    def fresh(cls, settings: Settings) -> Model:
        rng = np.random.default_rng(settings.seed)
        d, f = settings.dimension, settings.filters
        embeddings = rng.normal(0, 0.1, (settings.buckets, d)).astype(np.float32)
        embeddings[0] = 0
        kernels = [rng.normal(0, 1 / np.sqrt(w * d), (w * d, f)).astype(np.float32) for w in settings.widths]
        return cls(settings, embeddings, kernels, [np.zeros(f, np.float32) for _ in settings.widths], rng.normal(0, 0.3, f * len(settings.widths)).astype(np.float32), 0.0)

    def _vectors(self, ids: np.ndarray) -> np.ndarray:
        x = self.embeddings[ids[:, 0]]
        for k in range(1, ids.shape[1]):
            x = x + self.embeddings[ids[:, k]]
        return x

    def pooled(self, ids: np.ndarray, first: np.ndarray, places: bool = False):
        """Largest response of each filter in each text; with ``places`` also the windows, and where it is."""
        x = self._vectors(ids)
        best, where, windows = [], [], []
        for w, kernel, bias in zip(self.settings.widths, self.kernels, self.biases):
            padded = np.vstack([x, np.zeros((w - 1, x.shape[1]), x.dtype)]) if w > 1 else x
            window = np.hstack([padded[k : k + len(x)] for k in range(w)]) if w > 1 else x
            y = window @ kernel + bias
            top = np.maximum.reduceat(y, first[:-1], axis=0)
            best.append(top)
            if places:
                at = np.empty(top.shape, np.int64)
                for t, (a, b) in enumerate(zip(first, first[1:])):
                    at[t] = a + y[a:b].argmax(axis=0)
                where.append(at)
                windows.append(window)
        return (np.hstack(best), where, windows) if places else np.hstack(best)

    def logits(self, texts: Texts) -> np.ndarray:
        if len(texts.first) < 2:
            return np.empty(0)
        return np.maximum(self.pooled(texts.ids, texts.first), 0).astype(np.float64) @ self.weights + self.bias

    def scores(self, texts: Texts) -> np.ndarray:
        """Probability-like scores; 0.5 is the threshold of the text's language."""
        return 1 / (1 + np.exp(-np.clip(self.logits(texts) - self.thresholds[texts.language], -40, 40)))


def train(column: pa.Array, labels: np.ndarray, settings: Settings) -> Model:
    """Fit by Adagrad on the logistic loss; both labels weigh the same. One fifth calibrates the thresholds."""
    model = Model.fresh(settings)
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(labels))
    fit, held = order[len(order) // 5 :], order[: len(order) // 5]
    if not len(fit) or labels.min() == labels.max():
        # Nothing to tell apart: every text gets the only label's side.
        model.weights[:] = 0
        model.bias = 1.0 if len(labels) and labels[0] == 1 else -1.0
        return model
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    cache = [np.full_like(a, 1e-4) for a in (*model.kernels, *model.biases, model.weights)]
    table, bias_cache = np.full(len(model.embeddings), 1e-4, np.float32), 1e-4
    for epoch in range(settings.epochs):
        fit = rng.permutation(fit)
        for a in range(0, len(fit), settings.batch):
            own = fit[a : a + settings.batch]
            texts = Texts(column.take(pa.array(own)), settings)
            raw, where, windows = model.pooled(texts.ids, texts.first, places=True)
            hidden = np.maximum(raw, 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ model.weights + model.bias, -30, 30)))
            delta = ((p - labels[own]) * weight[own] / len(own)).astype(np.float32)
            grads = [None] * len(cache)
            grads[-1] = hidden.T @ delta + 1e-4 * model.weights
            back = delta[:, None] * model.weights * (raw > 0)
            f, d = settings.filters, settings.dimension
            rows, vectors = [], []
            below = np.vstack([texts.ids, np.zeros((max(settings.widths), texts.ids.shape[1]), np.int64)])
            for i, (w, at, window) in enumerate(zip(settings.widths, where, windows)):
                g = back[:, i * f : (i + 1) * f]
                chosen = window[at]  # texts x filters x (w * d)
                grads[i] = np.einsum("tf,tfk->kf", g, chosen)
                grads[len(settings.widths) + i] = g.sum(axis=0)
                into = g[:, :, None] * model.kernels[i].T[None]
                for k in range(w):
                    for j in range(below.shape[1]):
                        rows.append(below[at + k, j].ravel())
                        vectors.append(into[:, :, k * d : (k + 1) * d].reshape(-1, d))
            rows, vectors = np.concatenate(rows), np.concatenate(vectors)
            real = (rows > 0) & (vectors != 0).any(axis=1)
            touched, at = np.unique(rows[real], return_inverse=True)
            step = np.zeros((len(touched), d), np.float32)
            np.add.at(step, at, vectors[real])
            table[touched] += (step**2).mean(axis=1)
            model.embeddings[touched] -= 5 * settings.rate * step / np.sqrt(table[touched])[:, None]
            for param, grad, seen in zip((*model.kernels, *model.biases, model.weights), grads, cache):
                seen += grad**2
                param -= settings.rate * grad / np.sqrt(seen)
            bias_cache += float(delta.sum()) ** 2
            model.bias -= settings.rate * float(delta.sum()) / np.sqrt(bias_cache)
    calibrate(model, column, labels, held if len(held) else fit)
    return model


def calibrate(model: Model, column: pa.Array, labels: np.ndarray, rows: np.ndarray) -> None:
    """For each language the threshold in the middle of the cut that makes the fewest errors; a language with fewer than
    ten rows of a label takes the one of all."""

    def cut(logit, y):
        order = np.argsort(logit)
        logit, y = logit[order], y[order]
        weight = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))
        # Errors if everything from position i on is called toxic.
        errors = np.append(0, np.cumsum(weight * (y == 1))) + np.append(np.cumsum((weight * (y == 0))[::-1])[::-1], 0)
        best = np.flatnonzero(errors <= errors.min() + 1e-12)
        i = int(best[len(best) // 2])
        padded = np.concatenate([[logit[0] - 1], logit, [logit[-1] + 1]])
        return (padded[i] + padded[i + 1]) / 2

    taken = column.take(pa.array(rows))
    parts = [Texts(taken.slice(a, b - a), model.settings) for a, b in slices(taken)]
    language = np.concatenate([p.language for p in parts])
    logit, y = np.concatenate([model.logits(p) for p in parts]), labels[rows]
    common = cut(logit, y)
    for i in range(len(LANGUAGES)):
        own = language == i
        enough = min((y[own] == 1).sum(), (y[own] == 0).sum()) >= 10
        model.thresholds[i] = cut(logit[own], y[own]) if enough else common


def sample(docs: DataFrame, labels: DataFrame, label: str, training: F.Column, rows: int, most_bytes: int) -> tuple[pa.Array, np.ndarray]:
    """A bounded sample of labelled texts: at most ``rows`` of each label by a hash of the id, none over ``most_bytes``.

    The ids are chosen from the labels alone; the list that is broadcast has at most twice ``rows`` entries.
    """
    known = labels.where(training & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("y"))
    picked = None
    for y in (0, 1):
        own = least_by_hash(known.where(F.col("y") == y), "doc_id", rows)
        picked = own if picked is None else picked.union(own)
    got = (
        docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).where(F.octet_length("text") <= most_bytes)
        .join(F.broadcast(picked), "doc_id").orderBy("doc_id", "y").limit(2 * rows).select("text", "y").toArrow()
    )
    return got.column("text").combine_chunks().cast(pa.large_string()), got.column("y").to_numpy().astype(np.int64)


def fold(doc_id: str = "doc_id", folds: int = 5) -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> Model:
    """A model from the labelled documents of the training folds (crc32(doc_id as text) mod 5 not 0).

    The sample is bounded by ``rows`` texts of each label of at most ``most_bytes``, so the fit in the driver costs
    the same at every size of the corpus. Rows whose label is null or whose document is missing do not count.
    """
    return train(*sample(docs, labels, "toxic", fold() != 0, rows, most_bytes), settings)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, language and score of every whole text, of any length.

    Only the text goes into a score; the language that picks the threshold is read from the text too. Null and empty
    texts get the score of a text without words. Repeated rows get the same score each; no rows, no scores; other
    columns are not read. The model that is broadcast has a fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            for a, b in slices(batch.column(1)):
                texts = Texts(batch.column(1).slice(a, b - a), own.settings)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([LANGUAGES[i] for i in texts.language]), pa.array(own.scores(texts))],
                    ["doc_id", "language", "score"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, language string, score double")
