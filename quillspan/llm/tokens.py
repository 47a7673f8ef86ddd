"""Token counts of a byte-pair vocabulary with word ends, by rank-synchronous merging of arrays.

A batch's texts are normalised and split into pre-tokens; each different pre-token is merged once. All of them lie
in one flat array of symbols. A round finds the rank of every neighbouring pair by binary search, the lowest rank of
each sequence by a segmented minimum, and merges every pair of that rank in all sequences at once (from the left
where pairs overlap). Sequences without a mergeable pair leave; what is left of a sequence are its tokens.

The vocabulary file is read on the driver from the path that is given and broadcast as arrays (48,894 merges). Each
Python worker remembers at most ``REMEMBERED`` pre-tokens; a text is cut nowhere.

Defined results: a null or empty text has 0 bytes and 0 tokens; strings of special tokens inside a text are one token
each; repeated rows each have a result; a null id is passed on; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from quillspan.llm import words as W
from quillspan.llm.common import by_batch
from quillspan.llm.registry import query, table

LIMIT = 2048
REMEMBERED = 400_000

# Fixed values of the format: white space, and the printable stand-ins of bytes in byte-level vocabularies.
_SPACE = regex.compile("[\t-\r \x85\xa0  -     　]+")
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _stand_ins() -> dict[int, str]:
    rest = [b for b in range(256) if b not in _PRINTABLE]
    return {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Symbols of bytes, inside a word and at its end; merges as sorted pairs with rank and result."""

    pattern: str
    special: list[str]
    inner: np.ndarray
    last: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    remembered: dict = field(default_factory=dict, repr=False)

    @staticmethod
    def load(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model, end = data["model"], data["model"]["end_of_word_suffix"]
        ids, stand_ins = model["vocab"], _stand_ins()
        pairs = np.array([(ids[a] << 32) | ids[b] for a, b in model["merges"]], np.int64)
        merged = np.array([ids[a + b] for a, b in model["merges"]], np.int64)
        order = np.argsort(pairs, kind="stable")
        pattern = next(p["pattern"]["Regex"] for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        return Vocabulary(
            pattern.replace(r"\s", _SPACE.pattern[1:-2]),
            [t["content"] for t in data["added_tokens"]],
            np.array([ids[stand_ins[b]] for b in range(256)], np.int64),
            np.array([ids[stand_ins[b] + end] for b in range(256)], np.int64),
            pairs[order],
            order.astype(np.int64),
            merged[order],
        )

    def normalised(self, text: str) -> str:
        if not text.isascii():
            # Letter by letter, so a capital sigma is never final.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return _SPACE.sub(" ", text).lower()

    def lengths(self, words: list[str]) -> np.ndarray:
        """The number of tokens of each pre-token."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(w) for w in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols, ends = self.inner[data], np.cumsum(sizes)
        symbols[ends - 1] = self.last[data[ends - 1]]
        out = np.zeros(len(words), np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        while len(symbols):
            keys = (symbols[:-1] << 32) | symbols[1:]
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            found = (self.pairs[at] == keys) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(found, self.ranks[at], np.iinfo(np.int64).max), np.iinfo(np.int64).max)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            counts = np.diff(np.append(first, len(owner)))
            lowest = np.minimum.reduceat(rank, first)
            done = lowest == np.iinfo(np.int64).max
            out[owner[first[done]]] = counts[done]
            chosen = (rank == np.repeat(lowest, counts)) & ~np.repeat(done, counts)
            places = np.flatnonzero(chosen)
            # Pairs that overlap form runs; every second one of a run merges, from its left end.
            run = np.append(True, np.diff(places) != 1)
            start = np.maximum.accumulate(np.where(run, np.arange(len(places)), 0)) if len(places) else places
            places = places[(np.arange(len(places)) - start) % 2 == 0]
            symbols = symbols.copy()
            symbols[places] = self.merged[at[places]]
            kept = ~np.repeat(done, counts)
            kept[places + 1] = False
            symbols, owner = symbols[kept], owner[kept]
        return out


def _count(shared):
    def work(batch):
        vocabulary = shared.value
        split = regex.compile(vocabulary.pattern)
        special = regex.compile("|".join(map(regex.escape, vocabulary.special))) if vocabulary.special else None
        known = vocabulary.remembered
        texts = batch.column("_text")
        sizes = np.diff(W.buffers(texts)[1])
        done, totals = 0, np.concatenate([[0], np.cumsum(sizes)])
        counts = np.zeros(batch.num_rows, np.int64)
        while done < batch.num_rows:
            to = max(done + 1, int(np.searchsorted(totals, totals[done] + W.CHUNK // 2, side="right")) - 1)
            found, missing = [], set()
            for i, text in enumerate(texts.slice(done, to - done).to_pylist(), done):
                parts = [text or ""]
                if special is not None and "<|" in parts[0]:
                    parts = special.split(parts[0])
                    counts[i] += len(parts) - 1
                words = [w for part in parts for w in split.findall(vocabulary.normalised(part))]
                found.append(words)
                missing.update(words)
            fresh = [w for w in missing if w not in known]
            if len(known) + len(fresh) > REMEMBERED:
                known.clear()
                fresh = list(missing)
            if fresh:
                known.update(zip(fresh, vocabulary.lengths(fresh).tolist()))
            for i, words in enumerate(found, done):
                counts[i] += sum(map(known.__getitem__, words))
            done = to
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in batch.schema.names if c != "_text"), pa.array(sizes, pa.int64()), pa.array(counts)],
            names=[*(c for c in batch.schema.names if c != "_text"), "n_bytes", "n_tokens"],
        )

    return work


def count_tokens(docs: DataFrame, vocabulary_path: str, *, text_col: str = "text", keep: list[str], limit: int = LIMIT) -> DataFrame:
    """The columns ``keep`` of each document with ``n_bytes, n_tokens, over_limit``."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path))
    rows = docs.select(*(docs[c].alias(f"k_{c}") for c in keep), docs[text_col].cast("string").alias("_text"))
    types = ", ".join(f"`{c}` {t}" for c, t in rows.drop("_text").dtypes)
    counted = by_batch(rows, f"{types}, n_bytes bigint, n_tokens bigint", _count(shared))
    return counted.select(*(F.col(f"k_{c}").alias(c) for c in keep), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


@query("op5_tokens")
def op5(spark, sf_dir):
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])
