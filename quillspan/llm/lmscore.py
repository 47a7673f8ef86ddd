"""Language-model scores by a weighted backoff automaton over word n-grams.

Learning counts all words of all learning texts (the end of a text is a word too), and all their bigrams and trigrams,
whatever the words. Counting is partial sums in the tasks and one shuffle per order, which grow with the corpus;
n-grams are dealt to buckets by hash and travel as compressed arrays, a row for each run of texts and bucket.
N-grams that occur twice at least become states and arcs, however many there are; their probabilities are interpolated
absolute discounting, so that the weights a state gives to its arcs and to its failure arc add up to one. An n-gram
can occur twice only if its parts do, so n-grams with another part never leave the scan; how many occur once, which the
discount asks for, is what the others leave of all positions.

A position takes its state's arc, or fails to the next shorter context at the failure arc's weight until one has the
arc. So a text's log-probability is a sum over its words (the weight from the root and the failure weight of the
word as a context), its bigrams that are states (what their arc has beyond failing to the root, and their failure
weight) and its trigrams that are arcs (what they have beyond failing to the bigram). States, arcs and weights are
Spark tables; the words and n-grams of the texts are dealt to the same buckets as the weights. Only the ``HEAD`` most frequent words and the
``GRAM_HEAD`` most frequent n-grams of each order are broadcast, which keeps hot keys out of the joins; the joined
tables have all others, so neither size changes a result. Bitmaps only keep rows from leaving a scan.

Words and n-grams are known by 63 and 64 bits of hash.

Defined results: a null or empty text is its end alone; texts that are not learned from still count as held out or
not by their id, a null id being held out never and learned from never; without learning texts all scores
use the one unknown word, with probability 1; repeated rows each count and each have a result; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from quillspan.llm import words as W
from quillspan.llm.common import Bitmap, by_batch, cut
from quillspan.llm.language import bucket_of
from quillspan.llm.registry import query, table
from quillspan.plans.durable import release

HEAD, GRAM_HEAD, BITS = 1 << 17, 1 << 17, 26
#: N-grams to a bucket, about: buckets grow in number, not in size.
SHARE = 1 << 20
#: Bytes whose words are found at once, words whose n-grams are dealt at once, bits of a bitmap that make a segment.
PIECE, RUN, SEGMENT = 1 << 20, 1 << 19, 20
#: Hashes of words have this bit, so as numbers they are below all places of the head.
_TOP = np.uint64(1 << 63)
#: The hash that stands for the end of a text.
END = np.uint64(0x6A09E667F3BCC909) | _TOP
#: Stands where a word does in the row that counts all positions.
_ALL = 1 << 40
_LEAST = 1e-12
# The primes and the seed of the 64-bit xxHash, as Spark's xxhash64 uses them.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
_SEED = np.uint64(42)


def _tokens(words: W.Words):
    """Hashes of all words with an end after each text, and the texts they belong to."""
    n = len(words.first) - 1
    hashes = np.insert(words.hashes | _TOP, words.first[1:], END)
    rows = np.repeat(np.arange(n), words.counts + 1)
    return hashes, rows


def _texts(batch):
    """``(from, to, hashes, rows)`` for runs of whole texts with about ``RUN`` words; longer texts are runs of their own."""
    parts, begin, size = [], 0, 0
    for a, b, words in W.chunks(batch.column("_text"), W.SPACED_FOLDED, PIECE):
        hashes, rows = _tokens(words)
        parts.append((hashes, rows + (a - begin)))
        size += len(hashes)
        if size >= RUN or b == batch.num_rows:
            yield begin, b, *(np.concatenate(x) for x in zip(*parts))
            parts, begin, size = [], b, 0


class Lookup:
    """Which place each of some hashes has in the array they came in: a table of open addresses."""

    def __init__(self, hashes: np.ndarray):
        bits = len(hashes).bit_length() + 2
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.places, self.keys = np.full(1 << bits, -1, np.int32), np.zeros(1 << bits, np.uint64)
        todo, slot = np.arange(len(hashes)), self._slots(hashes)
        while len(todo):
            free = self.places[slot] < 0
            self.places[slot[free]] = todo[free]
            left = self.places[slot] != todo
            todo, slot = todo[left], (slot[left] + 1) & self.mask
        self.keys[self.places >= 0] = hashes[self.places[self.places >= 0]]

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes << np.uint64(1) >> self.shift).astype(np.int64)  # the upper bit of all words is the same

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places, or -1."""
        slot = self._slots(hashes)
        places = self.places[slot]
        other = np.flatnonzero((self.keys[slot] != hashes) & (places >= 0))
        slot = slot[other]
        while len(other):
            slot = (slot + 1) & self.mask
            places[other] = self.places[slot]
            left = (self.keys[slot] != hashes[other]) & (places[other] >= 0)
            other, slot = other[left], slot[left]
        return places


def _codes(head: Lookup, hashes: np.ndarray) -> np.ndarray:
    """The place of a word of the head, else its hash, which is negative."""
    places = head.find(hashes)
    return np.where(places >= 0, places, hashes.view(np.int64))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What ``xxhash64(a, b)`` is in Spark: two successive words, or an n-gram's first and last part."""
    h = np.full(len(a), _SEED)
    for x in (a.view(np.uint64), b.view(np.uint64)):
        h = (h + _P5 + np.uint64(8)) ^ (_turned(x * _P2, 31) * _P1)
        h = _turned(h, 27) * _P1 + _P4
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h = h ^ (h >> np.uint64(32))
    return h


def _packed(values: list[np.ndarray]) -> bytes:
    """Arrays of equally many 64-bit numbers as planes of their bytes, compressed."""
    planes = np.stack([x.view(np.int64) for x in values]).view(np.uint8).reshape(len(values), -1, 8)
    return pa.compress(np.ascontiguousarray(planes.transpose(0, 2, 1)), codec="zstd", asbytes=True)


def _unpacked(count: int, width: int, data: bytes) -> np.ndarray:
    """The ``width`` arrays of ``count`` numbers that :func:`_packed` made ``data`` of."""
    planes = np.frombuffer(pa.decompress(data, decompressed_size=count * width * 8, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, 8, count).transpose(0, 2, 1)).view(np.int64).reshape(width, count)


def _dealt(keys: np.ndarray, values: list[np.ndarray], buckets: int) -> tuple[list, list, list]:
    """Buckets that ascending ``keys`` lie in, how many lie in each, and the packed ``values`` of those."""
    edges = np.searchsorted((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1))
    some = np.flatnonzero(np.diff(edges))
    return some.tolist(), np.diff(edges)[some].tolist(), [_packed([x[edges[b] : edges[b + 1]] for x in values]) for b in some]


_DEALT = "bucket int, count bigint, data binary, positions bigint"


def _runs(ascending: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    return np.flatnonzero(np.append(True, ascending[1:] != ascending[:-1])) if len(ascending) else np.zeros(0, np.int64)


def _dealt_grams(keys, parts, positions, buckets):
    """Different n-grams of a chunk with their counts, packed by bucket; the first row has the number of positions."""
    order = np.argsort(keys)
    keys = keys[order]
    first = _runs(keys)
    counts, keys, order = np.diff(np.append(first, len(keys))), keys[first], order[first]
    some, sizes, data = _dealt(keys, [*(x[order] for x in parts), counts], buckets)
    some, sizes, data = (some, sizes, data) if some else ([0], [0], [None])
    return pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), pa.array(sizes, pa.int64()), pa.array(data, pa.binary()), pa.array([positions] + [0] * (len(some) - 1), pa.int64())],
        names=["bucket", "count", "data", "positions"],
    )


def _bitmap(hashes: DataFrame, column: str) -> Bitmap:
    """A bitmap of 2 ** ``BITS`` bits, filled in the tasks and put together by segment, so only its bytes travel."""
    size, segments = 1 << SEGMENT - 3, 1 << BITS - SEGMENT

    def fill(batches):
        own = np.zeros(segments * size, np.uint8)
        for batch in batches:
            at = (batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - BITS)).astype(np.int64)
            for bit in range(8):
                own[at[at & 7 == bit] >> 3] |= np.uint8(1 << bit)
        parts = [x if x.any() else None for x in own.reshape(segments, size)]
        some = [i for i, x in enumerate(parts) if x is not None]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([pa.compress(parts[i], codec="zstd", asbytes=True) for i in some], pa.binary())], names=["segment", "data"])

    def join(batches):
        found = {}
        for batch in batches:
            for i, data in zip(batch.column("segment").to_pylist(), batch.column("data")):
                part = np.frombuffer(pa.decompress(data.as_buffer(), decompressed_size=size, codec="zstd"), np.uint8)
                found[i] = found[i] | part if i in found else part
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())], names=["segment", "data"])

    types = "segment int, data binary"
    rows = hashes.select(column).mapInArrow(fill, types).repartitionById(min(segments, 8), F.col("segment") % 8).mapInArrow(join, types)
    whole = np.zeros((segments, size), np.uint8)
    for row in rows.collect():  # at most 2 ** (BITS - 3) bytes
        whole[row["segment"]] = np.frombuffer(row["data"], np.uint8)
    return Bitmap.of(whole.reshape(-1), BITS)


def _deal_words(buckets):
    def work(batch):
        for _, _, hashes, _ in _texts(batch):
            yield _dealt_grams(hashes << np.uint64(1), [hashes], 0, buckets)

    return work


def _deal_bigrams(head, often, buckets):
    """Counts of two successive words that both may occur twice."""

    def work(batch):
        for _, _, hashes, rows in _texts(batch):
            same = rows[:-1] == rows[1:]
            twice = often.value.has(hashes)
            at = np.flatnonzero(same & twice[:-1] & twice[1:])
            codes = _codes(head.value, hashes)
            v, w = codes[at], codes[at + 1]
            yield _dealt_grams(_pair(v, w), [v, w], int(same.sum()), buckets)

    return work


def _deal_trigrams(head, often, buckets):
    """Counts of three successive words whose two bigrams may be states."""

    def work(batch):
        for _, _, hashes, rows in _texts(batch):
            codes = _codes(head.value, hashes)
            two = _pair(codes[:-1], codes[1:])
            state = often.value.has(two) & (rows[:-1] == rows[1:])
            at = np.flatnonzero(state[:-1] & state[1:])
            yield _dealt_grams(_pair(two[at], two[at + 1]), [codes[at], codes[at + 1], codes[at + 2]], int((rows[2:] == rows[:-2]).sum()), buckets)

    return work


_NAMES = {1: ["word"], 2: ["v", "w"], 3: ["context", "inner"]}


def _repeats(order: int):
    """Counts of the n-grams of a task's buckets, beyond words of those that occur twice at least; the row of ``_ALL`` counts all positions."""

    def run(batches):
        parts, positions = [], 0
        for batch in batches:
            positions += sum(batch.column("positions").to_pylist())
            for count, data in zip(batch.column("count").to_pylist(), batch.column("data")):
                if count:
                    parts.append(_unpacked(count, order + 1, data.as_buffer()))
        *codes, counts = np.concatenate(parts, axis=1) if parts else np.zeros((order + 1, 0), np.int64)
        del parts
        ends = codes if order < 3 else [W.signed(_pair(codes[0], codes[1])), W.signed(_pair(codes[1], codes[2]))]
        grams = codes[0] if order == 1 else _pair(*ends)
        by_gram = np.argsort(grams)
        first = _runs(grams[by_gram])
        n = np.add.reduceat(counts[by_gram], first) if len(first) else counts
        if order > 1:
            first, n = first[n > 1], n[n > 1]
        columns = [*(x[by_gram[first]] for x in ends), n]
        if positions:
            columns = [np.append(x, y) for x, y in zip(columns, (_ALL, _ALL, positions))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[*_NAMES[order], "n"])

    return run


def _counted(dealt: DataFrame, buckets: int, order: int, name: str) -> DataFrame:
    return cut(dealt.repartitionById(buckets, "bucket").mapInArrow(_repeats(order), ", ".join(f"{c} bigint" for c in [*_NAMES[order], "n"])), name)


def _split(counted: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The rows with a count that no more than ``most`` rows reach, and the others.

    Counts are compared by their first two digits, so a few thousand sums reach the driver at most.
    """
    digits = F.greatest(F.length(F.col("n").cast("string")) - 2, F.lit(0))
    step = F.pow(F.lit(10.0), digits).cast("long")
    sizes = counted.groupBy((F.expr("n") - F.col("n") % step).alias("floor")).agg(F.count(F.lit(1)).alias("k")).collect()
    floor, left = None, most
    for row in sorted(sizes, key=lambda r: -r["floor"]):
        left -= row["k"]
        if left < 0:
            break
        floor = row["floor"]
    return (counted.limit(0), counted) if floor is None else (counted.where(F.col("n") >= floor), counted.where(F.col("n") < floor))


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


def _repeated(kept: DataFrame) -> tuple[DataFrame, float]:
    """The n-grams that occur twice at least, by name, and the discount of their order."""
    first, last, _ = kept.columns
    is_all = (F.col(first) == _ALL) & (F.col(last) == _ALL)
    r = kept.agg(
        F.sum(F.when(is_all, F.col("n"))).alias("positions"), F.sum(F.when(~is_all, F.col("n"))).alias("n"), F.count_if(~is_all & (F.col("n") == 2)).alias("twice")
    ).first()
    return kept.where(~is_all).withColumn("gram", F.xxhash64(first, last)), _discount((r["positions"] or 0) - (r["n"] or 0), r["twice"])


def _attach(rows: DataFrame, key: str, head: DataFrame, rest: DataFrame, **values: str) -> DataFrame:
    """``rows`` with the ``values`` (new name = column) that ``head``, which is small, or ``rest`` has for their ``key``."""
    id_col = rest.columns[0]
    few, many = (t.select(F.col(id_col).alias(key), *(F.col(c).alias(k) for k, c in values.items())) for t in (head, rest))
    of_head = rows.join(F.broadcast(few), key)  # at most HEAD or GRAM_HEAD rows
    return of_head.unionByName(rows.join(F.broadcast(few.select(key)), key, "left_anti").join(many, key))


@dataclass
class Weights:
    """What n-grams of the head add to a score; which others may add something."""

    head: Lookup
    weights: np.ndarray  # by place, the last for -1
    others: Bitmap

    def of(self, hashes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the wanted are of the head, which may be below it, and what the head adds."""
        places = np.where(wanted, self.head.find(hashes), -1)
        hit = places >= 0
        return hit, wanted & ~hit & self.others.has(hashes), self.weights[places]


#: What a row of the last shuffle is: a document, words or n-grams asked for, weights of words or n-grams.
_DOC, _WORDS, _GRAMS, _OF_WORDS, _OF_GRAMS = range(5)
_ASKED = "bucket int, kind int, first bigint, count bigint, data binary"


def _score(shared, buckets, types: pa.Schema):
    """Per text: tokens, known ones, base and model scores of the head; per bucket: words and n-grams below it with their texts."""

    def work(batch):
        head, base_of, root_of, grams = shared.value
        names = [c for c in batch.schema.names if c != "_text"]
        for a, b, hashes, rows in _texts(batch):
            places = head.find(hashes)
            codes = np.where(places >= 0, places, hashes.view(np.int64))
            n = b - a
            model = np.bincount(rows, root_of[places], n)
            two = _pair(codes[:-1], codes[1:])
            inside = rows[:-1] == rows[1:]
            hit, low_two, more = grams.of(two, inside)
            model += np.bincount(rows[:-1], more, n)
            # An arc's bigrams are states both.
            arc = hit | low_two
            at = np.flatnonzero(arc[:-1] & arc[1:])
            three, of = _pair(two[at], two[at + 1]), rows[at]
            _, low_three, more = grams.of(three, np.ones(len(at), bool))
            model += np.bincount(of, more, n)
            found, of = np.concatenate([two[low_two], three[low_three]]), np.concatenate([rows[:-1][low_two], of[low_three]])
            low = places < 0
            part, row = batch.slice(a, n), batch.column("_row")[a].as_py()
            yield _filled(
                types,
                n,
                {c: part.column(c) for c in names}
                | {
                    "n_tokens": np.bincount(rows, minlength=n).astype(np.int64),
                    "known": np.bincount(rows, ~low, n).astype(np.int64),
                    "base": np.bincount(rows, base_of[places], n),
                    "model": model,
                    "bucket": (np.arange(row, row + n) % buckets).astype(np.int32),
                    "kind": np.full(n, _DOC, np.int32),
                    "first": np.full(n, row, np.int64),
                },
            )
            for kind, keys, texts in ((_WORDS, hashes[low], rows[low]), (_GRAMS, found, of)):
                order = np.argsort(keys)
                yield _filled(types, *_packed_rows(kind, row, keys[order], [texts[order]], buckets))

    return work


def _filled(types: pa.Schema, n: int, columns: dict) -> pa.RecordBatch:
    """``n`` rows with these columns, and nulls in the others of ``types``."""
    return pa.RecordBatch.from_arrays(
        [columns[t.name] if isinstance(columns.get(t.name), pa.Array) else pa.array(columns[t.name], t.type) if t.name in columns else pa.nulls(n, t.type) for t in types], names=types.names
    )


def _packed_rows(kind: int, first: int, keys: np.ndarray, values: list[np.ndarray], buckets: int) -> tuple[int, dict]:
    # The upper bit of all words is the same.
    some, sizes, data = _dealt(keys << np.uint64(1) if kind in (_WORDS, _OF_WORDS) else keys, [keys, *values], buckets)
    return len(some), {"bucket": some, "kind": [kind] * len(some), "first": [first] * len(some), "count": sizes, "data": data}


def _deal_weights(kind: int, buckets: int, types: pa.Schema):
    """Rows of a key and its weights, packed by bucket."""

    def work(batch):
        keys, *values = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
        order = np.argsort(keys.view(np.uint64))
        yield _filled(types, *_packed_rows(kind, 0, keys.view(np.uint64)[order], [x[order] for x in values], buckets))

    return work


def _answer(types: pa.Schema):
    """Documents as they are; for each run of texts that asks a bucket, one row of what its weights add to which text."""

    def run(batches):
        packed = {k: [] for k in (_WORDS, _GRAMS, _OF_WORDS, _OF_GRAMS)}
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            docs = np.flatnonzero(kinds == _DOC)
            if len(docs):
                yield batch.take(pa.array(docs)).select(types.names)
            for i in np.flatnonzero(kinds != _DOC).tolist():
                packed[kinds[i]].append(tuple(batch.column(c)[i].as_py() for c in ("first", "count", "data")))
        for asked, weights, width in ((_WORDS, _OF_WORDS, 3), (_GRAMS, _OF_GRAMS, 2)):
            if not packed[asked] or not packed[weights]:
                continue
            keys, *values = np.concatenate([_unpacked(n, width, data) for _, n, data in packed.pop(weights)], axis=1)
            keys = keys.view(np.uint64)
            order = np.argsort(keys)
            keys, values = keys[order], [x.view(np.float64)[order] for x in values]
            columns = {"first": [], "count": [], "data": []}
            for first, n, data in packed.pop(asked):
                wanted, texts = _unpacked(n, 2, data)
                at = np.minimum(np.searchsorted(keys, wanted.view(np.uint64)), len(keys) - 1)
                hit = keys[at] == wanted.view(np.uint64)
                at, texts = at[hit], texts[hit]
                times = np.bincount(texts)
                some = np.flatnonzero(times)
                none = np.zeros(len(some))
                base, model = ([none] if asked == _GRAMS else []) + [np.bincount(texts, x[at])[some] for x in values]
                known = times[some] if asked == _WORDS else none.astype(np.int64)
                for name, x in zip(columns, (first, len(some), _packed([some, known, base, model]))):
                    columns[name].append(x)
            yield _filled(types, len(columns["first"]), columns)

    return run


def _summed(names: list[str]):
    """Documents with what the buckets add to them."""

    def run(batches):
        docs, added = [], []
        for batch in batches:
            is_doc = batch.column("data").is_null()
            docs.append(batch.filter(is_doc))
            for x in batch.filter(pc.invert(is_doc)).select(["first", "count", "data"]).to_pylist():
                texts, *sums = _unpacked(x["count"], 4, x["data"])
                added.append((x["first"] + texts, *sums))
        if not docs:
            return
        rows = pa.Table.from_batches(docs).combine_chunks()
        rows = rows.take(pc.sort_indices(rows["_row"]))
        if added:
            of, known, base, model = (np.concatenate(x) for x in zip(*added))
            at = np.searchsorted(rows["_row"].to_numpy(), of)
            for name, more in (("known", known), ("base", base.view(np.float64)), ("model", model.view(np.float64))):
                whole = rows[name].to_numpy() + np.bincount(at, more, rows.num_rows).astype(more.dtype)
                rows = rows.set_column(rows.column_names.index(name), name, pa.array(whole))
        yield from rows.select(names).to_batches()

    return run


def _learn(texts: DataFrame):
    """The words with counts and failure weights below the head, what is broadcast, the n-grams' weights below the head, and sums."""
    spark = texts.sparkSession
    sc = spark.sparkContext
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = _counted(by_batch(texts, _DEALT, _deal_words(buckets)), buckets, 1, "words")
    sums = words.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"), F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).first()
    total, distinct, d1 = sums["total"] or 0, sums["distinct"], _discount(sums["once"], sums["twice"])
    top, low_words = _split(words, HEAD)
    top = top.toArrow()
    hashes, counts = top["word"].to_numpy().view(np.uint64), top["n"].to_numpy()
    by_count = np.lexsort((top["word"].to_numpy(), -counts))
    hashes, counts = hashes[by_count], counts[by_count]
    head = Lookup(hashes)
    shared_head = sc.broadcast(head)

    buckets = -(-total // SHARE) or 1
    often = sc.broadcast(_bitmap(words.where("n > 1"), "word"))
    stored2 = _counted(by_batch(texts, _DEALT, _deal_bigrams(shared_head, often, buckets)), buckets, 2, "grams2")
    bigrams, d2 = _repeated(stored2)
    often = sc.broadcast(_bitmap(bigrams, "gram"))
    stored3 = _counted(by_batch(texts, _DEALT, _deal_trigrams(shared_head, often, buckets)), buckets, 3, "grams3")
    trigrams, d3 = _repeated(stored3)

    # Failure weights of words.
    taken = cut(bigrams.groupBy("v").agg(F.sum(F.col("n") - d2).alias("taken")), "taken")
    of_head = taken.where("v >= 0").toArrow()  # at most HEAD rows
    left = np.ones(len(counts))
    left[of_head["v"].to_numpy()] -= of_head["taken"].to_numpy() / counts[of_head["v"].to_numpy()]
    left = np.maximum(left, _LEAST)
    failing = F.greatest(1 - F.coalesce("taken", F.lit(0.0)) / F.col("n"), F.lit(_LEAST))
    low_words = cut(low_words.join(taken.withColumnRenamed("v", "word"), "word", "left").select("word", "n", failing.alias("left")), "low_words")
    release(taken, words)
    few = spark.createDataFrame(pa.table({"word": np.arange(len(counts)), "n": counts.astype(np.int64), "left": left}))

    # What bigrams add, and their failure weights.
    states = _attach(bigrams, "v", few, low_words, n_v="n", left2="left")
    states = _attach(states, "w", few, low_words, n_w="n")
    alone = F.col("left2") * (F.col("n_w") - d1) / float(max(total, 1))
    states = states.select("gram", "n", alone.alias("alone"), ((F.col("n") - d2) / F.col("n_v") + alone).alias("p"))
    taken = trigrams.groupBy(F.col("context").alias("gram")).agg(F.sum(F.col("n") - d3).alias("taken"))
    states = states.join(taken, "gram", "left").select("gram", "n", "p", failing.alias("left"), F.log10(F.col("p") / F.col("alone") * failing).alias("weight"))
    states = cut(states, "states")
    release(stored2)

    # What trigrams add.
    few, many = _split(states, GRAM_HEAD)
    few = cut(few, "few_states")
    arcs = _attach(trigrams, "context", few, many, n_c="n", left3="left")
    arcs = _attach(arcs, "inner", few, many, p2="p")
    lower = F.col("left3") * F.col("p2")
    arcs = cut(arcs.select("gram", "n", F.log10(((F.col("n") - d3) / F.col("n_c") + lower) / lower).alias("weight")), "arcs")
    release(stored3)
    few_arcs, many_arcs = _split(arcs, GRAM_HEAD)
    grams = few.select("gram", "weight").union(few_arcs.select("gram", "weight")).toArrow()
    low_grams = cut(many.select("gram", "weight").union(many_arcs.select("gram", "weight")), "low_grams")
    release(states, arcs, few)
    hashes = grams["gram"].to_numpy().view(np.uint64)
    weights = Weights(Lookup(hashes), np.append(grams["weight"].to_numpy(), 0.0), _bitmap(low_grams, "gram"))
    # The one unknown word has what the discount leaves of the words that are known; it is the last, for -1.
    unknown = -np.log10(total + distinct + 1), np.log10(d1 * distinct / total if total else 1.0)
    base_of = np.append(np.log10((counts + 1) / (total + distinct + 1)), unknown[0])
    root_of = np.append(np.log10((counts - d1) / max(total, 1) * left), unknown[1])
    # Words below the head are scored as unknown first, so their weights are what they have beyond that.
    low_words = low_words.select(
        "word", F.log10(F.col("n") + 1.0).alias("base"), (F.log10((F.col("n") - d1) / float(max(total, 1)) * F.col("left")) - float(unknown[1])).alias("model")
    )
    return low_words, sc.broadcast((head, base_of, root_of, weights)), low_grams, total


def score(docs: DataFrame, learned: DataFrame, *, text_col: str = "text", keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each document with ``n_tokens, n_known, train_tokens, base_score, score``.

    ``learned`` holds the learning texts in the column ``text_col``.
    """
    low_words, shared, low_grams, total = _learn(learned.select(learned[text_col].cast("string").alias("_text")))
    buckets = -(-low_grams.count() // SHARE) or 1

    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *(docs[c].alias(f"k_{c}") for c in keep), docs[text_col].cast("string").alias("_text"))
    sums = ", ".join([*(f"`{c}` {t}" for c, t in rows.drop("_text").dtypes), "n_tokens bigint, known bigint, base double, model double"])
    of_some = f"{sums}, first bigint, count bigint, data binary"
    of_sums, of_all = (to_arrow_schema(docs.sparkSession.createDataFrame([], x).schema) for x in (of_some, f"{sums}, {_ASKED}"))
    asked = by_batch(rows, f"{sums}, {_ASKED}", _score(shared, buckets, of_all))
    for kind, weights in ((_OF_WORDS, low_words), (_OF_GRAMS, low_grams)):
        asked = asked.union(by_batch(weights, f"{sums}, {_ASKED}", _deal_weights(kind, buckets, of_all)))
    found = asked.repartitionById(buckets, "bucket").mapInArrow(_answer(of_sums), of_some)
    found = found.repartition("first").mapInArrow(_summed(of_sums.names[:-3]), sums)
    return found.select(
        *(F.col(f"k_{c}").alias(c) for c in keep),
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        F.col("model").alias("score"),
    )


@query("op1_lm_scores")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(bucket_of(F.col("doc_id"), 7) == 2, F.lit(False))
    learned = docs.where(bucket_of(F.col("doc_id"), 7) != 2)
    found = score(docs, learned, keep=["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
