"""Token counts by a two-tier lookup of pre-tokens.

The lengths of frequent pre-tokens are a small table that every task gets; other pre-tokens
are encoded once per worker and remembered.  No pre-token is ever shuffled.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastline.llm.common import mapped

FREQUENT = 20_000  # rows of the broadcast table
COUNTERS = 60_000  # words that a task counts at a time
CACHE = 400_000  # pre-tokens that a worker remembers; a full cache starts anew
LIMIT = 2048
# Fixed values, as the tokenizer's file states them: its pre-token pattern and white space, and its special strings.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SPECIAL = regex.compile(r"<\|startoftext\|>|<\|endoftext\|>")
# Characters that the tokenizer's normaliser only lower-cases: assigned ones below U+0250, without
# control characters and those whose lower case or class could depend on the library.
_OTHER = regex.compile(r"[^\t\n\r\x20-\x7e¡-įı-ǃǍ-ǰǴ-ɏ‘-‟–—…]")
_WORKER: dict = {}


class Counting:
    """A worker's tokenizer, its table of frequent lengths and its cache."""

    def __init__(self, path: str, frequent: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.frequent, self.cache = frequent, {}

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def learn(self, pieces: list[str]) -> None:
        """Lengths of new pre-tokens: encoded side by side, one by one where they don't stay apart."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        for at in range(0, len(pieces), 2000):
            some = pieces[at : at + 2000]
            ids = self.tokenizer.encode(" ".join(some), add_special_tokens=False).word_ids
            if ids and ids[-1] == len(some) - 1 and all(i is not None for i in ids):
                self.cache.update(zip(some, np.bincount(ids, minlength=len(some)).tolist(), strict=True))
            else:
                self.cache.update((p, self.whole(p)) for p in some)

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text, as the library counts them."""
        out, open_ = [0] * len(texts), []
        missing: dict[str, None] = {}
        frequent, cache = self.frequent, self.cache
        for i, text in enumerate(texts):
            if "<|" in text and _SPECIAL.search(text):
                parts = _SPECIAL.split(text)
                out[i] += len(parts) - 1
            else:
                parts = [text]
            for part in parts:
                if not part:
                    continue
                if not part.isascii() and _OTHER.search(part) or part.isascii() and not part.isprintable() and _OTHER.search(part):
                    out[i] += self.whole(part)
                    continue
                pieces = _PIECE.findall(part.lower())
                some = list(map(frequent.get, pieces))
                if None in some:
                    rest = [p for p, n in zip(pieces, some, strict=True) if n is None]
                    out[i] += sum(n for n in some if n is not None)
                    missing.update(dict.fromkeys(p for p in rest if p not in cache))
                    open_.append((i, rest))
                else:
                    out[i] += sum(some)
        if missing:
            kept = {p: cache[p] for _, rest in open_ for p in rest if p in cache} if len(cache) > CACHE else {}
            self.learn(list(missing))
            cache.update(kept)
        for i, rest in open_:
            out[i] += sum(map(cache.__getitem__, rest))
        return out


def frequent_words(docs: DataFrame, rows: int = FREQUENT) -> list[str]:
    """About the most frequent words of all texts: each task's Misra-Gries counters, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for at in range(0, b.num_rows, 500):
                for t in b.column(0).slice(at, 500):
                    held.update((t.as_py() or "").lower().split())
                if len(held) > COUNTERS:
                    cut = sorted(held.values(), reverse=True)[COUNTERS // 2]
                    held = Counter({w: n - cut for w, n in held.items() if n > cut})
        some = held.most_common(rows)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], ["word", "n"])

    words = mapped(docs.select("text"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = words.where(F.octet_length("word") <= 64)
    return [r[0] for r in words.orderBy(F.desc("n"), "word").limit(rows).select("word").collect()]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, rows: int = FREQUENT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text of ``docs`` (doc_id, text); null counts as empty.

    ``path`` is a tokenizers file whose pre-tokens are those of word_bpe_49k.json.  Special
    strings inside a text count as one token each, none is added.  Texts with
    characters beyond the Latin blocks go through the library as they are.
    """
    spark = docs.sparkSession
    counting = Counting(path, {})
    pieces = sorted({p for w in frequent_words(docs, rows) if not _OTHER.search(w) for p in _PIECE.findall(w)})
    counting.learn(pieces)
    table = spark.sparkContext.broadcast(dict(counting.cache))  # pieces of at most ``rows`` words of 64 bytes
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _WORKER.get("path") != path or _WORKER.get("table") != table.value:
            _WORKER.update(path=path, table=table.value, counting=Counting(path, table.value))
        worker = _WORKER["counting"]
        for b in batches:
            text = pc.fill_null(b.column(1), "")
            n: list[int] = []
            for at in range(0, b.num_rows, 200):
                n += worker.counts(text.slice(at, 200).to_pylist())
            size = pc.cast(pc.binary_length(text), pa.int64())
            tokens = pa.array(n, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, tokens, pc.greater(tokens, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return mapped(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
