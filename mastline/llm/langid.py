"""Language identification by character models with interpolated Kneser-Ney smoothing.

Counts of character n-grams per language come from all training texts.  The model is a few
sorted hash arrays, one per order, that hold the log-probabilities of all languages side by
side; n-grams that no language has seen fall back to the next order with the context's
weight.  The language with the lowest cross-entropy per character wins; texts that no
language explains as well as its own calibration texts are marked rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastline.llm.common import mapped

ORDER = 4
REJECT_SHARE = 0.002
STEPS, MOST_NATS = 200, 40  # histogram of calibration: steps a nat, and the nats beyond which all share one step
SLICE_CHARS = 1 << 17
UNKNOWN = "und"
_BITS = 12  # of a character's code; higher code points share codes
_SPACE = 32
_LETTER: dict = {}


def letters() -> np.ndarray:
    """Code of each code point's lower case; 0 for what is no letter.  Built once per worker."""
    if not _LETTER:
        table = np.zeros(0x110000, np.uint16)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ord(ch.lower()[0])
                table[c] = low if low < 4096 else low % 3967 + 129
        _LETTER["table"] = table
    return _LETTER["table"]


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters' codes of all texts with one space for anything between, before and after; offsets of the texts."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in texts], np.int64)
    code = letters()[points]
    doc = np.repeat(np.arange(len(texts)), size)
    on = code > 0
    begins = on.copy()
    if len(on) > 1:
        begins[1:] &= ~(on[:-1] & (doc[1:] == doc[:-1]))
    at = np.flatnonzero(on)
    shift = np.cumsum(begins)[at] + doc[at]  # one space before each word, and one after each text
    words = np.bincount(doc[begins], minlength=len(texts))
    length = np.bincount(doc[at], minlength=len(texts)) + words + 1
    out = np.full(int(length.sum()), _SPACE, np.int64)
    out[np.arange(len(at)) + shift] = code[at]
    return out, np.append(0, np.cumsum(length))


def grams(code: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that ends at each position from ``order - 1`` on, its last character in the low bits."""
    n = len(code) - order + 1
    key = np.zeros(max(n, 0), np.int64)
    for k in range(order):
        key = (key << _BITS) | code[k : k + n] if n > 0 else key
    return key


def within(bounds: np.ndarray, order: int, n: int) -> np.ndarray:
    """Whether the n-gram ending at each position lies in one text."""
    ok = np.ones(n, bool)
    for b in bounds[1:-1]:
        ok[max(0, b - order + 1) : b] = False
    return ok


@dataclass
class Model:
    """Per order a sorted array of n-grams, their log-probabilities (n, languages) and their weights as contexts."""

    langs: list[str]
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    back: list[np.ndarray]
    floor: float
    limits: np.ndarray | None = None

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text in each language, and whether it has a letter."""
        code, bounds = codes(texts)
        n, top = len(texts), len(self.keys)
        total = np.zeros((len(code), len(self.langs)), np.float32)
        # Positions by how much of the text stands before them; the first of a text is given.
        since = np.arange(len(code)) - np.repeat(bounds[:-1], np.diff(bounds))
        todo = np.flatnonzero(since > 0)
        depth = np.minimum(since[todo] + 1, top)
        padded = np.concatenate([np.zeros(top, np.int64), code])
        key = np.zeros(len(todo), np.int64)
        for k in range(top):
            key |= padded[todo + top - k] << (_BITS * k)
        for order in range(top, 0, -1):
            mine = depth == order
            if not mine.any():
                continue
            at, k = todo[mine], key[mine] & ((1 << (_BITS * order)) - 1)
            row, hit = _find(self.keys[order - 1], k)
            total[at[hit]] += self.logp[order - 1][row[hit]]
            miss = np.flatnonzero(mine)[~hit]
            if order == 1:
                total[at[~hit]] += self.floor
            else:
                context = (k >> _BITS)[~hit]
                row, have = _find(self.keys[order - 2], context)
                total[at[~hit][have]] += self.back[order - 2][row[have]]
                depth[miss] = order - 1
        size = np.diff(bounds)
        sums = np.add.reduceat(total, bounds[:-1], axis=0) if n else total
        return -sums / np.maximum(size - 1, 1)[:, None], size > 1

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        h, known = self.entropies(texts)
        if not len(texts):
            return [], np.zeros(0), np.zeros(0, bool)
        best = h.argmin(1)
        p = np.exp(-(h - h.min(1, keepdims=True)).astype(np.float64))
        score = np.where(known, 1 / p.sum(1), 0.0)
        low = h[np.arange(len(best)), best]
        rejected = ~known | (low > self.limits[best] if self.limits is not None else False)
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)], score, rejected


def _find(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    row = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return row, table[row] == key


def count_ngrams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) of the highest order over all texts (text, lang); counts are added up in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            langs = np.array(b.column(1).to_pylist(), object)
            for lang in sorted(set(langs)):
                rows = np.flatnonzero(langs == lang)
                for texts in _chunks(b.column(0).take(pa.array(rows))):
                    code, bounds = codes(texts)
                    key = grams(code, order)
                    key = key[within(bounds, order, len(key))]
                    gram, n = np.unique(key, return_counts=True)
                    if lang in held:
                        gram, at = np.unique(np.concatenate([held[lang][0], gram]), return_inverse=True)
                        n = np.bincount(at, np.concatenate([held[lang][1], n]), len(gram)).astype(np.int64)
                    held[lang] = (gram, n)
                    if len(gram) > 2_000_000:
                        yield _batch(lang, *held.pop(lang))
        for lang, (gram, n) in held.items():
            yield _batch(lang, gram, n)

    return mapped(docs.select("text", "lang"), run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _batch(lang: str, gram: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])


def _chunks(column: pa.Array) -> Iterator[list[str]]:
    some, size = [], 0
    for t in column:
        some.append(t.as_py() or "")
        size += len(some[-1])
        if size > SLICE_CHARS:
            yield some
            some, size = [], 0
    if some:
        yield some


def kneser_ney(langs: list[str], lang: np.ndarray, gram: np.ndarray, count: np.ndarray, order: int = ORDER) -> Model:
    """Interpolated Kneser-Ney from counts of the highest order; lower orders count distinct left neighbours."""
    width = len(langs)
    levels: list[list] = [[None] * order for _ in langs]
    every: list[list] = [[] for _ in range(order)]
    for i in range(width):
        g, c = gram[lang == i], count[lang == i].astype(np.float64)
        for k in range(order, 0, -1):
            if k < order:
                g, c = np.unique(upper_suffix, return_counts=True)
                c = c.astype(np.float64)
            else:
                o = np.argsort(g)
                g, c = g[o], c[o]
            levels[i][k - 1] = (g, c)
            every[k - 1].append(g)
            upper_suffix = g & ((1 << (_BITS * (k - 1))) - 1)
    keys = [np.unique(np.concatenate(x)) if x else np.zeros(0, np.int64) for x in every]
    prob = [np.zeros((len(k), width)) for k in keys]
    back = [np.zeros((len(k), width)) for k in keys]
    size = len(keys[0]) + 1
    for i in range(width):
        for k in range(1, order + 1):
            g, c = levels[i][k - 1]
            ones, twos = (c == 1).sum(), (c == 2).sum()
            d = min(max(ones / (ones + 2 * twos), 0.1), 0.9) if ones + twos else 0.5
            if k == 1:
                all_, kinds = max(c.sum(), 1.0), len(c)
                p = np.full(len(keys[0]), max(d * kinds, d) / all_ / size)
                p[np.searchsorted(keys[0], g)] += np.maximum(c - d, 0) / all_
                prob[0][:, i] = p
                continue
            context = g >> _BITS
            name, at = np.unique(context, return_inverse=True)
            all_, kinds = np.bincount(at, c, len(name)), np.bincount(at, minlength=len(name))
            weight = d * kinds / all_
            # Every context ends in an n-gram of the order below; the weights live there.
            row, hit = _find(keys[k - 2], name)
            back[k - 2][row[hit], i] = np.log(weight[hit])
            seen = keys[k - 1]
            low, ok = _find(keys[k - 2], seen & ((1 << (_BITS * (k - 1))) - 1))
            lower = np.where(ok, prob[k - 2][low, i], 1e-9)
            crow, chit = _find(name, seen >> _BITS)
            p = lower * np.where(chit, weight[crow] if len(name) else 1.0, 1.0)
            mine = np.searchsorted(seen, g)
            p[mine] += np.maximum(c - d, 0) / all_[at]
            prob[k - 1][:, i] = p
    return Model(langs, keys, [np.log(np.maximum(p, 1e-12)).astype(np.float32) for p in prob], [b.astype(np.float32) for b in back], float(np.log(1e-6)))


def fit(docs: DataFrame, order: int = ORDER) -> Model | None:
    """A model from all rows of ``docs`` (doc_id, text, lang) with text and lang; None if there are none.

    Counts are taken over everything and all distinct n-grams are kept: discounts and
    continuation counts are those of the whole corpus and no language is cut.  The model's size
    is that of the distinct n-grams times the languages; it is built on the driver.
    """
    rows = docs.where("text is not null and lang is not null")
    table = count_ngrams(rows, order).toArrow()
    if not table.num_rows:
        return None
    langs = sorted(set(table.column("lang").unique().to_pylist()))
    lang = pc.index_in(table.column("lang"), pa.array(langs, pa.string())).to_numpy()
    model = kneser_ney(langs, lang, table.column("gram").to_numpy(), table.column("n").to_numpy(), order)
    model.limits = _limits(rows, model)
    return model


def _limits(rows: DataFrame, model: Model) -> np.ndarray:
    """Per language the cross-entropy that REJECT_SHARE of its training texts pass, from a histogram of all of them."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {x: i for i, x in enumerate(sent.value.langs)}
        counts = np.zeros((len(index), MOST_NATS * STEPS + 1), np.int64)
        for b in batches:
            at = 0
            for texts in _chunks(b.column(0)):
                h, known = sent.value.entropies(texts)
                lang = np.array([index.get(x, -1) for x in b.column(1).slice(at, len(texts)).to_pylist()])
                at += len(texts)
                here = np.flatnonzero(known & (lang >= 0))  # texts without letters tell nothing
                step = np.minimum(np.ceil(h[here, lang[here]] * STEPS), MOST_NATS * STEPS)
                np.add.at(counts, (lang[here], step.astype(np.int64)), 1)
        i, step = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(step), pa.array(counts[i, step])], ["i", "step", "n"])

    parts = mapped(rows.select("text", "lang"), run, "i long, step long, n long")
    # As many rows as languages and steps at most.
    found = parts.groupBy("i", "step").agg(F.sum("n").alias("n")).toArrow()
    i, step, n = (found.column(k).to_numpy() for k in range(3))
    limits = np.full(len(model.langs), np.inf)
    for k in range(len(limits)):
        mine = np.flatnonzero(i == k)
        mine = mine[np.argsort(step[mine])]
        if len(mine):
            below = np.cumsum(n[mine])
            limits[k] = step[mine][np.searchsorted(below, (1 - REJECT_SHARE) * below[-1])] / STEPS * 1.05
    return limits


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every whole text of ``docs`` (doc_id, text).

    Null texts and texts without a letter are ``und`` with score 0; so is everything without a
    model.  Ties go to the first language by name.  ``rejected`` marks texts that fit
    no language as calibrated.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    if model is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a row per distinct n-gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, rejected = [], [], []
            for texts in _chunks(b.column(1)):
                x, s, r = sent.value.predict(texts)
                lang += x
                score.append(s)
                rejected.append(r)
            every = [np.concatenate([*x, np.zeros(0, k)]) for x, k in ((score, float), (rejected, bool))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), *(pa.array(x) for x in every)], ["doc_id", "lang_pred", "score", "rejected"])

    return mapped(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def language_report(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row, learned from rows that are not held out.

    Each row is judged by its own whole text, rows that repeat a doc_id or a text too.  Texts without
    a letter, empty or null, are ``und``, and so is all without a row to learn from.  Equal
    entropies go to the first language.  Other columns are not read; an empty table gives no rows.
    """
    model = fit(docs.where(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
