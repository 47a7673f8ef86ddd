"""Encoding texts into the pieces of a byte-pair model with byte fallback, and decoding them, by rounds of merges.

A batch's texts are cut into words (marks of white space and what follows them), and each different word is encoded
once. All of them lie in one flat array of symbols, cut further wherever two neighbouring characters stand side by
side in no piece of the model, since no piece can span such a place. A round finds each neighbouring pair's rank by
binary search and the lowest rank of each segment by a segmented minimum, merges its pairs from the left in all
segments at once, and compacts the arrays; segments without a pair leave. In a segment whose lowest rank may, once
merged, give a pair of the same or a lower rank, only the leftmost pair merges in that round, since the new pair goes
before the rest. So every segment sees the merges of the sequential rule (lowest rank first, leftmost first among
equals) and ends with the same pieces. A character that is no piece becomes the pieces of its UTF-8 bytes.

Pieces that are runs of one character and all have the worst rank (the runs of blanks in some models) need no rounds:
what is left of such a run is cut at once as the leftmost rule would cut it.

The model file is read on the driver from the path that is given and broadcast as arrays. Each Python worker remembers
at most ``REMEMBERED`` words; a text is cut nowhere else. Decoding gathers the pieces' bytes by array operations; bytes
that are no UTF-8 become U+FFFD one by one.

Defined results: a null text is empty, and an empty text has no pieces beyond the end id; null ids decode to an empty
text and null entries to nothing; ids that the model has not raise an error; repeated rows each have a result; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import codecs
import re
import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from quillspan.llm import words as W
from quillspan.llm.common import by_batch
from quillspan.llm.registry import query, table

REMEMBERED = 200_000
_CHUNK = W.CHUNK // 4
_NONE = np.iinfo(np.int64).max

# Fixed values of the model format: kinds of pieces, the mark of white space, and numbers of fields.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_MARK = "▁"
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3


def _fields(data: bytes):
    """``(number, value)`` of each field of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``starts[i] ... starts[i] + sizes[i] - 1``, one span after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _cut_run(n: int, allowed) -> list[int]:
    """The lengths that ``n`` equal characters end in if always the leftmost two neighbours of an allowed sum merge."""
    out: list[int] = []
    while n:
        if out and out[-1] + 1 in allowed:
            out[-1] += 1
            n -= 1
        else:
            step = 2 if n > 1 and 2 in allowed else 1
            out.append(step)
            n -= step
        while len(out) > 1 and out[-2] + out[-1] in allowed:
            out[-2:] = [out[-2] + out[-1]]
    return out


@dataclass
class Model:
    """Characters and their symbols, pairs of symbols with rank and result, and the bytes of each piece."""

    chars: np.ndarray  # code points that are symbols, ascending
    char_symbols: np.ndarray
    neighbours: np.ndarray  # pairs of code points that stand side by side in a piece, ascending
    pairs: np.ndarray  # pairs of symbols, ascending
    ranks: np.ndarray
    merged: np.ndarray
    eager: np.ndarray  # by rank: merging may give a pair of the same or a lower rank
    runs: tuple[int, int, dict[int, int]] | None  # the worst rank, its character and its pieces by length, if all are runs
    byte_ids: np.ndarray
    n_pieces: int
    end_id: int
    prefix: bool
    spelled: np.ndarray  # bytes of all pieces as they are decoded
    spelled_at: np.ndarray
    control: np.ndarray
    marked: np.ndarray  # pieces that begin with the mark of white space
    is_byte: np.ndarray
    words: dict = field(default_factory=dict, repr=False)
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32), repr=False)
    ids_at: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64), repr=False)

    @staticmethod
    def load(path: str) -> Model:
        with open(path, "rb") as f:
            top = list(_fields(f.read()))
        trainer, normalizer = (dict(_fields(next((v for k, v in top if k == n), b""))) for n in (_TRAINER, _NORMALIZER))
        if trainer.get(3) != 2 or trainer.get(24) or not trainer.get(35) or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("the model must be byte-pair with byte fallback, marks before words and no normalization")
        text, score, kind = [], [], []
        for number, value in top:
            if number == _PIECES:
                piece = dict(_fields(value))
                text.append(piece[1].decode())
                score.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kind.append(piece.get(3, _NORMAL))
        if _USER in kind or _UNUSED in kind:
            raise ValueError("user-defined and unused pieces are not supported")
        return Model._of(text, np.array(score), np.array(kind), trainer.get(42, 2), bool(normalizer.get(3, 1)))

    @staticmethod
    def _of(text: list[str], score: np.ndarray, kind: np.ndarray, end_id: int, prefix: bool) -> Model:
        n = len(text)
        normal = np.flatnonzero(kind == _NORMAL)
        symbol = {text[i]: int(i) for i in normal}
        for c in sorted({c for i in normal for c in text[i]} - symbol.keys()):
            symbol[c] = n + len(symbol)  # a part of pieces that is none itself
        levels = np.unique(-score[normal])
        rank = dict(zip(normal.tolist(), np.searchsorted(levels, -score[normal]).tolist()))
        found: dict[int, tuple[int, int]] = {}
        first_of, last_of = {}, {}  # for each symbol the lowest rank of the pieces that continue it on either side
        for i in normal.tolist():
            piece = text[i]
            for cut in range(1, len(piece)):
                a, b = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if a is not None and b is not None:
                    found[(a << 32) | b] = (rank[i], i)
                    first_of[a] = min(first_of.get(a, _NONE), rank[i])
                    last_of[b] = min(last_of.get(b, _NONE), rank[i])
        pairs = np.array(sorted(found), np.int64)
        results = np.array([found[p] for p in pairs.tolist()], np.int64).reshape(-1, 2)
        eager = np.zeros(len(levels), bool)
        for r, m in results.tolist():
            eager[r] |= min(first_of.get(m, _NONE), last_of.get(m, _NONE)) <= r
        worst = [text[i] for i in normal.tolist() if rank[i] == len(levels) - 1 and len(text[i]) > 1]
        runs = None
        if worst and len({c for t in worst for c in t}) == 1:
            runs = (len(levels) - 1, symbol[worst[0][0]], {1: symbol[worst[0][0]]} | {len(t): symbol[t] for t in worst})
        chars = {ord(s): i for s, i in symbol.items() if len(s) == 1}
        codes = np.array(sorted(chars), np.int64)
        sides = {(ord(a) << 32) | ord(b) for i in normal for a, b in zip(text[i], text[i][1:])}
        by_byte = {int(text[i][3:5], 16): int(i) for i in np.flatnonzero(kind == _BYTE)}
        said = [bytes([int(t[3:5], 16)]) if k == _BYTE else b"" if k == _CONTROL else " ⁇ ".encode() if k == _UNKNOWN else t.replace(_MARK, " ").encode() for t, k in zip(text, kind)]
        return Model(
            codes,
            np.array([chars[c] for c in codes.tolist()], np.int64),
            np.array(sorted(sides), np.int64),
            pairs,
            results[:, 0],
            results[:, 1],
            eager,
            runs,
            np.array([by_byte[b] for b in range(256)], np.int64),
            n,
            end_id,
            prefix,
            np.frombuffer(b"".join(said), np.uint8),
            np.concatenate([[0], np.cumsum([len(s) for s in said])]),
            kind == _CONTROL,
            np.array([t.startswith(_MARK) for t in text]),
            kind == _BYTE,
        )

    def _lookup(self, sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(sorted_keys, keys), max(len(sorted_keys) - 1, 0))
        return at, sorted_keys[at] == keys if len(sorted_keys) else np.zeros(len(keys), bool)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one word after the other, and how many each has."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array([len(w) for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        at, known = self._lookup(self.chars, codes)
        symbols = np.where(known, self.char_symbols[at], -1)
        starts = np.arange(len(codes))  # the character that a symbol begins with
        _, beside = self._lookup(self.neighbours, (codes[:-1] << 32) | codes[1:])
        cut = np.append(True, ~beside | (word[1:] != word[:-1]))
        segment = np.cumsum(cut) - 1
        done = []
        while len(symbols):
            keys = np.where((segment[1:] == segment[:-1]) & (symbols[:-1] >= 0) & (symbols[1:] >= 0), (symbols[:-1] << 32) | symbols[1:], -1)
            at, found = self._lookup(self.pairs, keys)
            rank = np.append(np.where(found, self.ranks[at], _NONE), _NONE)
            first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
            counts = np.diff(np.append(first, len(segment)))
            lowest = np.minimum.reduceat(rank, first)
            over = lowest == _NONE
            if self.runs is not None and (last := lowest == self.runs[0]).any():
                inside = np.repeat(last, counts)
                done.append(self._cut_runs(symbols[inside], starts[inside], segment[inside]))
                over_here = np.repeat(over, counts)
                done.append((symbols[over_here], starts[over_here]))
                over = over | last
            elif over.any():
                over_here = np.repeat(over, counts)
                done.append((symbols[over_here], starts[over_here]))
            gone = np.repeat(over, counts)
            places = np.flatnonzero((rank == np.repeat(lowest, counts)) & ~gone)
            if len(places):
                # Pairs that overlap form runs; every second one of a run merges, from its left end.
                run = np.append(True, np.diff(places) != 1)
                begin = np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))
                leftmost = np.append(True, segment[places[1:]] != segment[places[:-1]])
                places = places[np.where(self.eager[rank[places]], leftmost, (np.arange(len(places)) - begin) % 2 == 0)]
                symbols[places] = self.merged[at[places]]
            kept = ~gone
            kept[places + 1] = False
            symbols, starts, segment = symbols[kept], starts[kept], segment[kept]
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        symbols, starts = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(starts)
        symbols, starts = symbols[order], starts[order]
        spelled = np.flatnonzero((symbols < 0) | (symbols >= self.n_pieces))
        n_ids = np.ones(len(symbols), np.int64)
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in codes[starts[spelled]].tolist()]
        n_ids[spelled] = [len(r) for r in raw]
        ids = np.repeat(symbols, n_ids)
        ids[_ragged(np.cumsum(n_ids)[spelled] - n_ids[spelled], n_ids[spelled])] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return ids.astype(np.int32), np.bincount(word[starts], n_ids, len(words)).astype(np.int64)

    def _cut_runs(self, symbols, starts, segment):
        """Segments whose pairs are all parts of runs of one character, with those runs cut as the rule cuts them."""
        one, by_length = self.runs[1], self.runs[2]
        part = symbols == one
        head = np.flatnonzero(np.append(True, ~(part[1:] & part[:-1] & (segment[1:] == segment[:-1]))))
        totals = np.diff(np.append(head, len(symbols)))
        cuts = {n: _cut_run(n, by_length) for n in np.unique(totals[part[head]]).tolist()}
        lengths = [cuts[n] if p else [1] for n, p in zip(totals.tolist(), part[head].tolist())]
        which = np.repeat(np.arange(len(head)), [len(x) for x in lengths])
        lengths = np.array([n for x in lengths for n in x], np.int64)
        before = np.cumsum(lengths) - lengths
        first = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
        of_run = np.zeros(max(by_length) + 1, np.int64)
        of_run[list(by_length)] = list(by_length.values())
        return np.where(part[head][which], of_run[lengths], symbols[head][which]), starts[head][which] + before - before[first][which]

    def of_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other with its end, and how many each has."""
        found = [_WORD.findall(_marked(t, self.prefix)) for t in texts]
        missing = {w for ws in found for w in ws} - self.words.keys()
        if len(self.words) + len(missing) > REMEMBERED:
            missing = {w for ws in found for w in ws}
            self.words, self.ids, self.ids_at = {}, self.ids[:0], self.ids_at[:1]
        if missing:
            fresh = list(missing)
            ids, sizes = self.encode(fresh)
            self.words.update(zip(fresh, range(len(self.words), len(self.words) + len(fresh))))
            self.ids = np.concatenate([self.ids, ids])
            self.ids_at = np.concatenate([self.ids_at, self.ids_at[-1] + np.cumsum(sizes)])
        counts = np.array([len(ws) for ws in found], np.int64)
        at = np.fromiter((self.words[w] for ws in found for w in ws), np.int64, int(counts.sum()))
        # The end of a text is a span of its own behind its words.
        starts, sizes = self.ids_at[at], self.ids_at[at + 1] - self.ids_at[at]
        behind = np.cumsum(counts)
        sizes = np.insert(sizes, behind, 1)
        starts = np.insert(starts, behind, len(self.ids))
        ids = np.append(self.ids, np.int32(self.end_id))[_ragged(starts, sizes)]
        text = np.repeat(np.arange(len(texts)), counts + 1)
        return ids, np.bincount(text, sizes, len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts of lists of ids that lie one after the other."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.n_pieces):
            raise ValueError("an id that the model has not")
        row = np.repeat(np.arange(len(sizes)), sizes)
        starts, lengths = self.spelled_at[ids].copy(), np.diff(self.spelled_at)[ids]
        if self.prefix:
            # The first piece that says anything loses the blank that encoding put before the text.
            says = np.flatnonzero(~self.control[ids])
            first = says[np.append(True, row[says[1:]] != row[says[:-1]])] if len(says) else says
            first = first[self.marked[ids[first]]]
            starts[first] += 1
            lengths[first] -= 1
        data = self.spelled[_ragged(starts, lengths)].tobytes()
        ends = np.cumsum(np.bincount(row, lengths, len(sizes)).astype(np.int64)).tolist()
        return [data[a:b].decode("utf-8", "by_byte") for a, b in zip([0, *ends], ends)]


_WORD = re.compile(f"{_MARK}*[^{_MARK}]+|{_MARK}+")


def _marked(text: str, prefix: bool) -> str:
    return (_MARK if prefix and text else "") + text.replace(" ", _MARK)


def _by_byte(error: UnicodeDecodeError):
    return "�" * (error.end - error.start), error.end


def _encode(shared, decoded: bool):
    def work(batch):
        codecs.register_error("by_byte", _by_byte)
        texts = batch.column("_text")
        names = [c for c in batch.schema.names if c != "_text"]
        totals = np.concatenate([[0], np.cumsum(np.diff(W.buffers(texts)[1]))])
        done = 0
        while done < batch.num_rows:
            to = max(done + 1, int(np.searchsorted(totals, totals[done] + _CHUNK, side="right")) - 1)
            part = batch.slice(done, to - done)
            ids, sizes = shared.value.of_texts([t or "" for t in part.column("_text").to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(ids))
            said = [pa.array(shared.value.decode(ids, sizes), pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), lists, *said], names=[*names, "ids", *["decoded"] * decoded])
            done = to

    return work


def _decode(shared):
    def work(batch):
        codecs.register_error("by_byte", _by_byte)
        names = [c for c in batch.schema.names if c != "_ids"]
        lists = batch.column("_ids")
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = pc.list_flatten(lists)
        if ids.null_count:
            row = pc.list_parent_indices(lists).to_numpy()[pc.is_valid(ids).to_numpy(zero_copy_only=False)]
            sizes, ids = np.bincount(row, minlength=len(sizes)), ids.drop_null()
        texts = shared.value.decode(ids.to_numpy(), sizes)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], names=[*names, "decoded"])

    return work


def _load(df: DataFrame, model_path: str):
    return df.sparkSession.sparkContext.broadcast(Model.load(model_path))


def encode(docs: DataFrame, model_path: str, *, text_col: str = "text", keep: list[str], decoded: bool = False) -> DataFrame:
    """The columns ``keep`` of each document with ``ids``, the pieces of its text and the end id.

    With ``decoded``, the text that these ids decode to as well, in the same pass.
    """
    rows = docs.select(*(docs[c].alias(f"k_{c}") for c in keep), docs[text_col].cast("string").alias("_text"))
    types = ", ".join(f"`{c}` {t}" for c, t in rows.drop("_text").dtypes)
    found = by_batch(rows, f"{types}{', ' if keep else ''}ids array<int>{', decoded string' * decoded}", _encode(_load(docs, model_path), decoded))
    return found.select(*(F.col(f"k_{c}").alias(c) for c in keep), "ids", *["decoded"] * decoded)


def decode(rows: DataFrame, model_path: str, *, ids_col: str = "ids", keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row with ``decoded``, the text of its ids."""
    lists = rows.select(*(rows[c].alias(f"k_{c}") for c in keep), rows[ids_col].cast("array<int>").alias("_ids"))
    types = ", ".join(f"`{c}` {t}" for c, t in lists.drop("_ids").dtypes)
    found = by_batch(lists, f"{types}{', ' if keep else ''}decoded string", _decode(_load(rows, model_path)))
    return found.select(*(F.col(f"k_{c}").alias(c) for c in keep), "decoded")


@query("op13_pieces")
def op13(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    found = encode(table(spark, sf_dir, "documents"), path, keep=["doc_id"], decoded=True)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
