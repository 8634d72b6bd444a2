"""Secret scans: fixed patterns, and strings that look random to character Markov models.

Two first-order models, one of random strings and one of ordinary identifiers, are
trained on labelled samples; a string is a secret if its log-likelihood ratio says so.

Random are values of the fixed patterns in the texts and strings drawn from the usual alphabets.
Ordinary are words of the texts, names that Python's standard library defines, and what is made of
both by rule: names with numbers, paths, hosts, versions, dates and UUIDs.  A quarter of
the made strings is held out; the threshold is where each kind of ordinary ones has its
rate of false alarms at most.
"""

from __future__ import annotations

import hashlib
import importlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastline.llm.common import mapped

SAMPLE_ROWS = 200_000  # distinct strings of each label that are fitted, those with the smallest hashes
FEW_TEXTS = 20_000  # texts of which every distinct word is fitted
MIN_LENGTH = 16
MADE = 4000  # strings of each kind that are made
FALSE_ALARMS = 0.004  # of each kind of ordinary strings that are held out
MASS = 400_000.0  # pairs that the texts' words, and the made strings, each count for
# Kinds in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "model")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_HINTS = ("passw", "secret", "token", "api")
_LEAST_ASSIGN, _LEAST_ACCESS = 8, 16
# A character set without the stop: words and host names do not join to one string.
_STRING = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{4,}")
CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_INDEX = np.full(128, -1, np.int64)
_INDEX[[ord(c) for c in CHARS]] = np.arange(len(CHARS))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping per kind; in order of start, then kind."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS) and ("=" in text or ":" in text):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= _LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= _LEAST_ACCESS]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def ratios(counts: np.ndarray) -> np.ndarray:
    """Log-likelihood ratios of character pairs from pair counts (random, ordinary).

    The random model leans on the uniform one: a labelled sample of few alphabets must
    not make other alphabets look ordinary.
    """
    n = len(CHARS)
    drawn, ordinary = counts
    weight = 50.0 * n
    p = (drawn + weight / n) / (drawn.sum(1, keepdims=True) + weight)
    # The ordinary model falls back to how often each character follows any other.
    single = (ordinary.sum(0) + 0.5) / (ordinary.sum() + 0.5 * n)
    q = (ordinary + 5 * single) / (ordinary.sum(1, keepdims=True) + 5)
    return np.log(p) - np.log(q)


def pair_counts(strings: Iterator[str]) -> np.ndarray:
    n = len(CHARS)
    out = np.zeros(n * n)
    for s in strings:
        i = _INDEX[np.frombuffer(s.encode("ascii", "replace"), np.uint8) & 127]
        good = (i[:-1] >= 0) & (i[1:] >= 0)
        out += np.bincount(i[:-1][good] * n + i[1:][good], minlength=n * n)
    return out.reshape(n, n)


def library_names() -> list[str]:
    """Names that modules of the standard library define, in order."""
    modules = ("argparse", "ast", "asyncio", "calendar", "collections", "configparser", "ctypes", "datetime", "decimal", "email.message", "functools", "html.parser", "http.client", "inspect", "io", "json", "locale", "logging", "multiprocessing", "os", "pathlib", "pickle", "re", "shutil", "signal", "smtplib", "socket", "ssl", "statistics", "string", "subprocess", "tarfile", "tempfile", "threading", "tokenize", "typing", "unittest", "urllib.request", "uuid", "xml.dom.minidom", "zipfile")
    names: set[str] = set()
    for m in map(importlib.import_module, modules):
        names.update(dir(m))
        for value in vars(m).values():
            if isinstance(value, type):
                names.update(dir(value))
    return sorted(n.strip("_") for n in names if n.isascii() and len(n.strip("_")) > 2)


def made_samples(words: list[str], n: int = MADE) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
    """Strings by kind, ordinary and random, drawn by a fixed seed; ordinary ones from ``words`` and the library's names."""
    rng = random.Random(20240711)
    names = library_names()
    parts = sorted({p.lower() for name in names for p in re.split(r"_|(?<=[a-z])(?=[A-Z])", name) if p.isalpha() and len(p) > 2})
    words = [w.lower() for w in words if w.isalpha()] or parts

    def word() -> str:
        return rng.choice(parts if rng.random() < 0.6 else words)

    def some(low: int, high: int) -> list[str]:
        return [word() for _ in range(rng.randint(low, high))]

    def number() -> str:
        return str(rng.randrange(10 ** rng.randint(1, 4)))

    def identifier() -> str:
        if rng.random() < 0.2:
            return rng.choice(names)
        w = some(2, 4)
        kind = rng.randrange(5)
        joined = ("_".join(w), "-".join(w), "".join(x.capitalize() for x in w), w[0] + "".join(x.capitalize() for x in w[1:]), "_".join(w).upper())[kind]
        return joined + rng.choice(["", "", number(), f"_{number()}" if kind in (0, 4) else f"-{number()}" if kind == 1 else number()])

    def path() -> str:
        return rng.choice(["/", ""]) + "/".join(rng.choice([word(), word(), identifier(), number()]) for _ in range(rng.randint(2, 5)))

    def uuid() -> str:
        h = f"{rng.getrandbits(128):032x}"
        h = h if rng.random() < 0.8 else h.upper()
        return "-".join((h[:8], h[8:12], h[12:16], h[16:20], h[20:]))

    def date() -> str:
        day = f"{rng.randint(1990, 2039)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
        clock = "-".join(f"{rng.randrange(60):02}" for _ in range(3))
        return rng.choice([f"{day}T{clock}Z", f"{day}_{clock}", f"{word()}-{day}", f"{day.replace('-', '')}-{clock.replace('-', '')}", f"{word()}_{day.replace('-', '_')}"])

    def version() -> str:
        return "-".join([*some(1, 2), f"v{number()}", rng.choice([number(), word(), f"rc{number()}", f"x86_64-{word()}"])])

    ordinary = {"identifier": identifier, "path": path, "uuid": uuid, "date": date, "version": version}
    low, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    up = low.upper()
    alphabets = {"base62": up + low + digits, "base64": up + low + digits + "+/", "url": up + low + digits + "-_", "lower": low, "upper": up, "letters": up + low, "lower36": low + digits, "upper36": up + digits}
    random_ = {k: [("".join(rng.choices(a, k=rng.randint(MIN_LENGTH, 48)))) for _ in range(n)] for k, a in alphabets.items()}
    return {k: [make() for _ in range(n)] for k, make in ordinary.items()}, random_


def mean_ratio(string: str, table: np.ndarray) -> float:
    """Log-likelihood ratio per pair of characters."""
    i = _INDEX[np.frombuffer(string.encode(), np.uint8)]
    return float(table[i[:-1], i[1:]].mean())


class Model:
    """The pair table, and the ratio from which a string counts as random."""

    def __init__(self, corpus: np.ndarray, words: list[str]):
        ordinary, random_ = made_samples(words)
        fitted = lambda made: (s for v in made.values() for k, s in enumerate(v) if k % 4)
        made = pair_counts(fitted(ordinary))
        told = corpus[1] * min(1.0, MASS / max(1.0, corpus[1].sum()))
        self.table = ratios(np.stack([corpus[0] + pair_counts(fitted(random_)), told + made * MASS / made.sum()]))
        long = {k: [s for s in v[::4] if len(s) >= MIN_LENGTH] for k, v in ordinary.items()}
        scores = [np.sort([mean_ratio(s, self.table) for s in v]) for v in long.values()]
        self.threshold = max(float(x[int(np.ceil(len(x) * (1 - FALSE_ALARMS))) - 1]) for x in scores) + 1e-9

    def looks_random(self, string: str) -> bool:
        return mean_ratio(string, self.table) > self.threshold


def labelled_strings(docs: DataFrame) -> DataFrame:
    """(label, string, n): 1 for values of fixed patterns, 0 for other words of letters, of every text; distinct per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good: dict = {}
            bad: dict = {}
            for t in b.column(0):
                text = whole = t.as_py() or ""
                for s, e, kind in base_spans(whole):  # kinds may overlap: a run of hex digits may end in the a of api_key
                    value = _ASSIGN.match(whole, s, e)[2] if kind == "assign" else whole[s:e]
                    good[value] = None
                    text = text[:s] + " " * (e - s) + text[e:]
                for w in text.split():
                    if len(w) > 3:
                        bad[w] = bad.get(w, 0) + 1
            words = [w for w in bad if w.isascii() and _WORD.fullmatch(w) and sum(map(str.isdigit, w)) * 5 <= len(w)]
            strings = [*good, *words]
            yield pa.RecordBatch.from_arrays([pa.array([1] * len(good) + [0] * len(words), pa.int32()), pa.array(strings, pa.string())], ["label", "string"])

    return mapped(docs.select("text"), run, "label int, string string")


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """The models, from at most ``rows`` distinct strings of each label, those with the smallest hashes, and made ones.

    Any table will do, an empty one too: the made strings are always there.
    """
    labels = labelled_strings(docs).where(F.length("string") <= 200)
    # Of many texts a share of all distinct strings by hash, so that what is shuffled stays small; pairs are counted in tasks.
    share = 16 if docs.count() > FEW_TEXTS else 1
    some = labels.where((F.col("label") == 1) | (F.pmod(F.xxhash64("string"), F.lit(share)) == 0)).distinct()
    one = some.where("label = 1").orderBy(F.xxhash64("string"), "string").limit(rows)
    none = some.where("label = 0").orderBy(F.xxhash64("string"), "string").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(CHARS), len(CHARS))), np.zeros((len(CHARS), len(CHARS)))]
        for b in batches:
            label = b.column(0).to_pylist()
            text = b.column(1).to_pylist()
            for k in (0, 1):
                total[k] += pair_counts(s for s, x in zip(text, label, strict=True) if x == k)
        for k in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total[k].ravel().tolist()], pa.list_(pa.float64()))], ["label", "pairs"])

    counts = np.zeros((2, len(CHARS), len(CHARS)))
    for r in mapped(one.union(none), run, "label int, pairs array<double>").collect():
        counts[r[0]] += np.array(r[1]).reshape(len(CHARS), -1)
    words = [r[0] for r in none.select("string").limit(MADE).collect()]
    return Model(counts[[1, 0]], sorted(words))


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_model) of every row.

    Fixed spans stay as they are; the models add strings that overlap none.  Offsets are
    code points, ends exclusive.  Null counts as empty and has no spans.  Rows that repeat a doc_id or
    a text are scanned each; texts of any length are read whole, other columns, whatever their
    names, not at all.  An empty table gives no rows.
    """
    model = train(docs) if model is None else model
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind_of = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for t in b.column(1):
                text = t.as_py() or ""
                base = base_spans(text)
                every = list(base)
                for m in _STRING.finditer(text):
                    if not any(s < m.end() and m.start() < e for s, e, _ in base) and sent.value.looks_random(m[0]):
                        every.append((m.start(), m.end(), "model"))
                every.sort(key=lambda s: (s[0], KINDS.index(s[2])))
                kinds = [k for _, _, k in base]
                said, said_all = (",".join(f"{k}:{s}:{e}" for s, e, k in x) for x in (base, every))
                for c, v in zip(cols, (kinds.count("assign"), kinds.count("access"), kinds.count("hex"), hashlib.sha256(said.encode()).hexdigest(), said_all, len(every) - len(base)), strict=True):
                    c.append(v)
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model"]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, types, strict=True))], ["doc_id", *names])

    return mapped(docs.select("doc_id", "text"), run, f"doc_id {kind_of}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_model long")
