"""Toxicity by a small convolutional text classifier over hashed word embeddings.

Words are hashed; a sorted array of the hashes that the sample knows gives each its
embedding, all others share none.  Filters of several widths slide over the text, each
keeps its largest response, and a logistic unit joins them.  The filters are trained in
NumPy on a bounded sample; a threshold per language, with the language read off the text's
own words, is calibrated on all labelled rows that training has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastline.llm.common import Rolling, Words, byte_table, keyed, mapped, release, sized, sliced, utf8, without, written

SAMPLE_ROWS = 8_000  # labelled rows that are fitted, those with the smallest hashes
SAMPLE_WORDS = 20_000  # longer texts are scored but not fitted
KNOWN_WORDS = 1 << 16  # embeddings
WIDTHS = (1, 2, 3)
FILTERS = 8
DIM = 8
EPOCHS = 4
STEPS, MOST = 256, 30  # histogram of calibration: steps a logit, and the logit beyond which all share one step
SPARSE = 5  # toxic calibration rows below which a language takes the threshold of all
PRIOR = 6.0  # documents of prior weight behind a word's first estimate
_KEEP = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_TABLE = byte_table(_KEEP, lower=True)
_PAD = max(WIDTHS) - 1


@dataclass
class Model:
    """What a task needs to score: word hashes, filter responses per word, language votes, thresholds."""

    words: np.ndarray  # sorted hashes
    parts: list[np.ndarray]  # per width: (width, words + 1, filters)
    bias: np.ndarray
    out: np.ndarray
    base: float
    votes: np.ndarray  # (words + 1, languages): log-likelihood of the language
    slope: float
    cuts: np.ndarray  # per language: logit that scores 0.5

    def logits(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logit and language number of each text of a slice."""
        words = Words(data, bounds, _TABLE)
        row = known(self.words, hashes(words))
        n = len(bounds) - 1
        # Texts apart by empty rows, so that no filter spans two.
        gap = words.doc * _PAD
        line = np.zeros(words.n + (n + 1) * _PAD, np.int64)
        line[np.arange(words.n) + gap] = row
        begin = words.first[:-1] + np.arange(n) * _PAD
        response = []
        for part in self.parts:
            w = len(part)
            each = part[0][line[: len(line) - w + 1]]
            for k in range(1, w):
                each = each + part[k][line[k : len(line) - w + 1 + k]]
            response.append(np.maximum.reduceat(each, begin) if n else each[:0])
        pooled = np.maximum(np.concatenate(response, axis=1) + self.bias, 0)
        votes = np.concatenate([np.zeros((1, self.votes.shape[1])), np.cumsum(self.votes[row], axis=0, dtype=np.float64)])
        lang = np.argmax(votes[words.first[1:]] - votes[words.first[:-1]], axis=1)
        return pooled @ self.out + self.base, lang

    def scores(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        z, lang = self.logits(data, bounds)
        return 1 / (1 + np.exp(-np.clip(self.slope * (z - self.cuts[lang]), -30, 30)))


def hashes(words: Words) -> np.ndarray:
    return Rolling(words.text)(words.start[:-1], words.start[:-1] + words.length) if words.n else np.zeros(0, np.uint64)


def known(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Row of each hash in the sorted table plus one; 0 if it isn't there."""
    if not len(table):
        return np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return np.where(table[at] == h, at + 1, 0)


def train(texts: list[np.ndarray], toxic: np.ndarray, langs: np.ndarray, names: int, seed: int = 7) -> tuple[Model, np.ndarray]:
    """A model from hashed texts, and which of them were fitted.

    Three parts: words' first estimates, filters, and rows left for the thresholds; none sees another's rows.
    """
    rng = np.random.default_rng(seed)
    part = rng.permutation(len(texts)) % 20
    first, second = part < 8, (part >= 8) & (part < 15)

    def pairs(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sets = [np.unique(texts[i]) for i in np.flatnonzero(chosen)]
        return np.concatenate([*sets, np.zeros(0, np.uint64)]), np.repeat(np.flatnonzero(chosen), [len(s) for s in sets])

    h, doc = pairs(first)
    table, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    most = np.sort(np.argsort(-count, kind="stable")[:KNOWN_WORDS])
    most = most[count[most] >= 2]
    place = np.zeros(len(table), np.int64)
    place[most] = np.arange(1, len(most) + 1)
    table, row = table[most], place[inverse]
    n = len(table) + 1
    bad = np.bincount(row, toxic[doc], n)
    rate = max(toxic[first].mean(), 1e-3) if first.any() else 0.5
    odds = np.log((bad + PRIOR * rate) / (np.bincount(row, minlength=n) + PRIOR) / rate)
    odds[0] = 0
    emb = rng.normal(0, 0.05, (n, DIM))
    emb[:, 0] = odds
    emb[0] = 0
    votes = np.log(np.stack([np.bincount(row, langs[doc] == k, n) for k in range(names)], 1) + 0.5)
    votes -= np.log(np.array([(langs[first] == k).sum() for k in range(names)]) + 0.5)
    votes[0] = 0

    lines = [np.concatenate([known(table, t), np.zeros(_PAD, np.int64)]).astype(np.int32) for t in texts]
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[:, 0, : FILTERS // 2] += 1.0  # half the filters start from the first estimates
    bias, out, base = np.zeros(FILTERS * len(WIDTHS)), np.full(FILTERS * len(WIDTHS), 0.2), -2.0
    squares = [np.full_like(x, 1e-2) for x in (*filters, bias, out)]
    base_square, where = 1e-2, np.flatnonzero(second)

    def forward(line: np.ndarray) -> tuple[np.ndarray, list]:
        e, pooled, at = emb[line], [], []
        for f in filters:
            w = len(f)
            each = sum(e[k : len(e) - w + 1 + k] @ f[k] for k in range(w))
            top = each.argmax(0)
            at.append(top)
            pooled.append(each[top, np.arange(FILTERS)])
        return np.concatenate(pooled) + bias, at

    for epoch in range(EPOCHS):
        rate_now = 0.05 / (1 + epoch)
        for i in rng.permutation(where):
            raw, at = forward(lines[i])
            pooled = np.maximum(raw, 0)
            error = 1 / (1 + np.exp(-np.clip(pooled @ out + base, -30, 30))) - toxic[i]
            back = error * out * (raw > 0)
            grads = []
            for j, (f, top) in enumerate(zip(filters, at, strict=True)):
                own = back[j * FILTERS : (j + 1) * FILTERS]
                grads.append(np.stack([(emb[lines[i][top + k]] * own[:, None]).T for k in range(len(f))]) + 1e-4 * f)
                if own.any():
                    for k in range(len(f)):
                        np.subtract.at(emb, lines[i][top + k], 0.1 * rate_now * (f[k] * own).T)
            for x, g, s in zip((*filters, bias, out), (*grads, back, error * pooled + 1e-4 * out), squares, strict=True):
                s += g * g
                x -= rate_now * g / np.sqrt(s)
            emb[0] = 0
            base_square += error * error
            base -= rate_now * error / np.sqrt(base_square)

    return Model(table, [np.stack([emb @ f[k] for k in range(len(f))]).astype(np.float32) for f in filters], bias, out, float(base), votes.astype(np.float32), 1.0, np.zeros(names)), first | second


def calibrate(docs: DataFrame, labels: DataFrame, fitted: list[str], model: Model) -> np.ndarray:
    """Per language the logit with the best F1 on all labelled rows (__id, __toxic) whose doc_id was not fitted.

    Logits are counted in steps per language and label.  A language with under SPARSE toxic rows
    takes the threshold of all rows together.  Where no logit finds more toxic than clean
    rows, the threshold is above all that were seen.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    used = F.broadcast(spark.createDataFrame([(x,) for x in sorted(set(fitted))], "__used string"))  # SAMPLE_ROWS
    rest = sized(labels.join(used, F.col("__id").cast("string") == F.col("__used"), "left_anti"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(sent.value.cuts), 2, 2 * MOST * STEPS + 1), np.int64)
        for b in batches:
            toxic = (b.column(1).to_numpy(zero_copy_only=False) > 0).astype(np.int64)
            for first, last, data, bounds in sliced(*utf8(b.column(0))):
                z, lang = sent.value.logits(data, bounds)
                np.add.at(counts, (lang, toxic[first:last], np.floor((np.clip(z, -MOST, MOST) + MOST) * STEPS).astype(np.int64)), 1)
        lang, toxic, step = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (lang, toxic, step, counts[lang, toxic, step])], ["lang", "toxic", "step", "n"])

    parts = mapped(docs.join(rest, docs["doc_id"] == rest["__id"]).select("text", "__toxic"), run, "lang long, toxic long, step long, n long")
    # As many rows as languages, labels and steps at most.
    got = parts.groupBy("lang", "toxic", "step").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(model.cuts), 2, 2 * MOST * STEPS + 1), np.int64)
    lang, toxic, step, n = (got.column(k).to_numpy() for k in range(4))
    counts[lang, toxic, step] = n
    every = _best_cut(counts.sum(0))
    return np.array([_best_cut(c) if c[1].sum() >= SPARSE else every for c in counts])


def _best_cut(counts: np.ndarray) -> float:
    """From rows by label and step of the logit."""
    step = np.flatnonzero(counts.sum(0))[::-1]
    hits, n = np.cumsum(counts[1, step]), np.cumsum(counts[:, step].sum(0))
    f1 = np.where(2 * hits > n, 2 * hits / (n + max(1, counts[1].sum())), 0)
    if not len(step) or f1.max() <= 0:
        return float(max(step.max(initial=0) / STEPS - MOST, 0)) + 1.0
    i = int(f1.argmax())
    low = (step[i + 1] + 1) / STEPS if i + 1 < len(step) else step[i] / STEPS - 2
    return float(step[i] / STEPS * 0.5 + low * 0.5 - MOST)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from at most ``rows`` labelled rows (doc_id, toxic) and the texts and languages of ``docs``.

    Thresholds come from all labelled rows that were not fitted, however many there are.
    Rows are taken in the order of a hash of doc_id; of texts that share a doc_id and label the first
    in order is fitted.  Only texts of up to 8 * SAMPLE_WORDS characters are, and they come to
    the driver as word hashes: at most rows * 4 * SAMPLE_WORDS numbers, in practice far fewer.
    Null labels do not count.  None if there are no labelled texts or only one label.
    """
    chosen = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__toxic")).distinct()
    every = chosen
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("__id"), "__id", "__toxic").limit(rows))  # bounded by rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds = utf8(b.column(1))
            words = Words(data, bounds, _TABLE)
            h = hashes(words)
            cut = [h[words.first[i] : words.first[i + 1]].tobytes() for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cut, pa.binary()), b.column(2), b.column(3)], ["id", "h", "toxic", "lang"])

    lang = F.coalesce("lang", F.lit("")) if "lang" in docs.columns else F.lit("")
    sample = docs.join(chosen, docs["doc_id"] == chosen["__id"]).select(F.col("doc_id").cast("string"), "text", "__toxic", lang.alias("lang"))
    sample = sample.where(F.length("text") <= 8 * SAMPLE_WORDS).groupBy("doc_id", "__toxic").agg(F.min(F.struct("text", "lang")).alias("x"))
    sample = mapped(sample.select("doc_id", "x.text", "__toxic", "x.lang"), run, "id string, h binary, toxic int, lang string")
    got = sample.toArrow().sort_by([("id", "ascending"), ("toxic", "ascending"), ("h", "ascending")]).to_pydict()
    toxic = np.array(got["toxic"], np.float64)
    if not 0 < toxic.sum() < len(toxic):
        return None
    names = sorted(set(got["lang"]))
    langs = np.array([names.index(x) for x in got["lang"]])
    model, fitted = train([np.frombuffer(x, np.uint64) for x in got["h"]], toxic, langs, len(names))
    used = [got["id"][i] for i in np.flatnonzero(fitted)]
    del got, sample
    model.cuts = calibrate(docs, every, used, model)
    release()
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, predicted) of every text; without a model all score 0.  Empty and null texts score as a text without words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # KNOWN_WORDS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.zeros(b.num_rows)
            for first, last, data, bounds in sliced(*utf8(b.column(1))):
                s[first:last] = sent.value.scores(data, bounds)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return mapped(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double, predicted int")


def held_out() -> F.Column:
    return (F.crc32(F.col("doc_id").cast("string")) % 5) == 0


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, with labels learned from rows that are not held out.

    Each row is scored by its own whole text, rows that repeat a doc_id or a text too; rows without
    doc_id are not held out.  Null and empty texts score as one without words.  Of other columns
    only lang is read, for the thresholds.  Without labels all score 0; an empty table gives no rows.
    """
    model = fit(docs, labels.where(~held_out()))
    return score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` less the rows whose text the classifier rejects; columns, whatever their names, as they are.

    A rejected row goes by doc_id (null is a value) and text: others with its doc_id stay, repeats
    of it go with it.  Null and empty texts stay, texts are read whole, and without labels
    everything stays.
    """
    model = fit(docs, labels.where(~held_out()))
    gone = written(score(keyed(docs), model).where("predicted = 1").select("doc_id.*"), "toxic")
    return without(docs, gone)
