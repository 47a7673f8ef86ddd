"""Short codes for vectors: each part of a vector becomes the nearest entry of its part's codebook.

Components become integers, ``floor(scale * x)``, and vectors are cut into equal consecutive parts. Codebooks start as
the parts of the vectors with the smallest ids, and each round assigns every part to its nearest entry and moves every
entry to its parts' mean, all in integers.

A part keeps its entry with an upper bound of its distance, its ``b`` closest other entries with ordered lower bounds
and one outer bound for all remaining entries. When entries move, the bounds move by as much. A part whose upper bound
lies below all lower bounds keeps its entry unseen; for any other, integer distances decide: to its own entry first,
then to the listed entries that its bounds leave open, and to all entries only if the outer bound is open too. Bounds
are rounded outwards, so they never decide what integers would decide otherwise, and equal distances always reach the
integers, where the lower index wins. ``b`` starts at a quarter of the entries and shrinks, down to an eighth, to what
``SERVED`` of the parts that the lists have decided did need; what a list loses enters the outer bound.

A round is one pass over a table of vectors and bounds that writes the next such table; its tasks also write the sums
of their parts by entry, which Spark adds up. The table before it is deleted then. The driver holds the codebooks only.

Defined results: rows are dropped whose vector is null or holds a null, NaN or infinite component; so are vectors whose
length is not the commonest one among those that can be cut into the parts (the longer of equally common ones).
Components beyond ``+-LIMIT`` count as that. Null ids come last in the order of ids; rows of one id are ordered by
their vectors. With fewer vectors than entries a codebook has as many entries as there are vectors. Repeated rows each
count and each have a result; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillspan.llm.common import cut
from quillspan.llm.registry import query, table
from quillspan.plans.durable import release

SERVED = 0.99
LIMIT = 1 << 24
#: Labels with more than this share of all rows are joined by broadcast; there are fewer than its inverse.
HOT_SHARE = 0.001
_BLOCK = 1 << 19
_FAR = np.float32(np.inf)


def _below(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), -_FAR)


def _above(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), _FAR)


@dataclass
class Books:
    """The codebooks of all parts, and how far each entry has moved since the last round."""

    entries: np.ndarray  # (parts, entries, components)
    moved: np.ndarray  # (parts, entries), rounded up
    width: int  # of the lists that are kept

    def all_distances(self, part: int, x: np.ndarray) -> np.ndarray:
        book = self.entries[part]
        most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
        # Doubles are exact here as long as all sums stay below 2 ** 53.
        kind = np.float64 if 4 * most * most * x.shape[1] < 1 << 53 else np.int64
        a, b = x.astype(kind), book.astype(kind)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)

    def distances(self, part: np.ndarray, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        away = x - self.entries[part, entry]
        return (away * away).sum(1)


@dataclass
class State:
    """For each part of each vector its entry, its list and its bounds."""

    near: np.ndarray  # (rows, parts, 1 + width): the entry, then the list
    bounds: np.ndarray  # (rows, parts, 2 + width): upper, lower ones of the list, outer


def _ranked(books: Books, part: int, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    far = books.all_distances(part, x)
    order = np.argsort(far, axis=1, kind="stable")
    far = np.sqrt(np.take_along_axis(far, order, 1).astype(np.float64))
    outer = _below(far[:, 1 + width]) if far.shape[1] > 1 + width else np.full(len(x), _FAR, np.float32)
    return order[:, : 1 + width], np.column_stack([_above(far[:, 0]), _below(far[:, 1 : 1 + width]), outer])


def _begin(books: Books, x: np.ndarray) -> State:
    found = [_ranked(books, p, x[:, p], books.width) for p in range(x.shape[1])]
    return State(np.stack([f[0] for f in found], 1).astype(np.uint8), np.stack([f[1] for f in found], 1))


def _follow(books: Books, x: np.ndarray, state: State, used: np.ndarray) -> State:
    """The state after the entries have moved; ``used`` counts parts by how much of their lists they needed."""
    n, parts, d = x.shape
    width = state.near.shape[2] - 1
    at = np.tile(np.arange(parts), n)
    x, near, bounds = x.reshape(-1, d), state.near.reshape(-1, 1 + width).astype(np.int64), state.bounds.reshape(-1, 2 + width)
    bounds = np.column_stack([
        _above(bounds[:, 0] + books.moved[at, near[:, 0]]),
        _below(bounds[:, 1:-1] - books.moved[at[:, None], near[:, 1:]]),
        _below(bounds[:, -1] - books.moved.max(1)[at]),
    ])
    # In order: no bound lies above one behind it.
    bounds[:, 1:] = np.minimum.accumulate(bounds[:, :0:-1], axis=1)[:, ::-1]
    unsure = np.flatnonzero(~(bounds[:, 0] < bounds[:, 1]))
    own = books.distances(at[unsure], x[unsure], near[unsure, 0])
    bounds[unsure, 0] = _above(np.sqrt(own.astype(np.float64)))
    still = ~(bounds[unsure, 0] < bounds[unsure, 1])
    unsure, own = unsure[still], own[still]
    everything = ~(bounds[unsure, 0] < bounds[unsure, -1])

    some, own = unsure[~everything], own[~everything]
    open_ = (bounds[some, 1:-1] <= bounds[some, :1]).sum(1)
    used += np.bincount(open_, minlength=len(used))
    for m in np.unique(open_).tolist():
        rows = some[open_ == m]
        far = np.column_stack([own[open_ == m], *(books.distances(at[rows], x[rows], near[rows, j]) for j in range(1, m + 1))])
        entries = near[rows, : m + 1]
        order = np.lexsort((entries, far), axis=1)
        far = np.sqrt(np.take_along_axis(far, order, 1).astype(np.float64))
        near[rows, : m + 1] = np.take_along_axis(entries, order, 1)
        bounds[rows, 0] = _above(far[:, 0])
        bounds[rows, 1 : m + 1] = _below(far[:, 1:])
    rest = unsure[everything]
    for p in range(parts):
        rows = rest[at[rest] == p]
        if len(rows):
            near[rows], bounds[rows] = _ranked(books, p, x[rows], width)
    if books.width < width:
        lost = np.minimum.reduce(bounds[:, 1 + books.width :], axis=1)
        near, bounds = near[:, : 1 + books.width], np.column_stack([bounds[:, : 1 + books.width], lost])
    return State(near.astype(np.uint8).reshape(n, parts, -1), bounds.reshape(n, parts, -1))


def _fixed(column: pa.Array, kind, shape: tuple[int, ...]) -> np.ndarray:
    """A binary column whose values have one length, as an array."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind).reshape(len(column), *shape)


def _binary(values: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(values).reshape(len(values), -1)
    size = rows.shape[1] * rows.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _pass(shared, parts: int, dims: int, scale: int, first: bool, last: bool, keep: list[str], types: pa.Schema):
    """One round: the next state of all rows and, from each task, its sums by entry and its use of lists."""

    def work(batches):
        books: Books = shared.value
        _, k, d = books.entries.shape
        sums, counts = np.zeros((parts, k, d), np.int64), np.zeros((parts, k), np.int64)
        used = np.zeros(k + 1, np.int64)
        step = max(1, _BLOCK // dims)
        for whole in batches:
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                if first:
                    raw = batch.column("_vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    x = np.clip(np.floor(raw * scale), -LIMIT, LIMIT).astype(np.int64).reshape(-1, parts, d)
                    state = _begin(books, x)
                else:
                    x = _fixed(batch.column("x"), np.int32, (parts, d)).astype(np.int64)
                    near, bounds = _fixed(batch.column("near"), np.uint8, (parts, -1)), _fixed(batch.column("bounds"), np.float32, (parts, -1))
                    state = _follow(books, x, State(near, bounds), used)
                code = state.near[:, :, 0].astype(np.int64)
                kept = [batch.column(c) for c in keep]
                if last:
                    at = np.tile(np.arange(parts), len(x))
                    error = books.distances(at, x.reshape(-1, d), code.reshape(-1)).reshape(-1, parts).sum(1)
                    yield pa.RecordBatch.from_arrays([*kept, _binary(code.astype(np.uint8)), pa.array(error)], names=[*keep, "code", "error"])
                    continue
                for p in range(parts):
                    # Exact in doubles: a block has fewer than 2 ** 20 rows of components up to 2 ** 24.
                    sums[p] += ((code[:, p] == np.arange(k)[:, None]).astype(np.float64) @ x[:, p].astype(np.float64)).astype(np.int64)
                    counts[p] += np.bincount(code[:, p], minlength=k)
                none = pa.nulls(len(x), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept, _binary(x.astype(np.int32)), _binary(state.near), _binary(state.bounds), none], names=[*keep, "x", "near", "bounds", "sums"])
        if not last and counts.any():
            total = np.concatenate([sums.ravel(), counts.ravel(), used])
            nulls = [pa.nulls(1, types.field(c).type) for c in keep]
            yield pa.RecordBatch.from_arrays([*nulls, *[pa.nulls(1, pa.binary())] * 3, pa.array([total.tolist()], pa.list_(pa.int64()))], names=[*keep, "x", "near", "bounds", "sums"])

    return work


def _root_up(squares: np.ndarray) -> np.ndarray:
    return np.where(squares > 0, _above(np.sqrt(squares.astype(np.float64))), np.float32(0))


def _next(books: Books, total: np.ndarray) -> Books:
    """The codebooks after a round, and the width of lists that it asks for."""
    parts, k, d = books.entries.shape
    sums, counts, used = np.split(total, [parts * k * d, parts * k * (d + 1)])
    sums, counts = sums.reshape(parts, k, d), counts.reshape(parts, k, 1)
    entries = np.where(counts > 0, sums // np.maximum(counts, 1), books.entries)
    away = entries - books.entries
    width = books.width
    if used.sum():
        needed = int(np.searchsorted(np.cumsum(used), SERVED * used.sum()))
        width = min(width, max(-(-k // 8), needed))
    return Books(entries, _root_up((away * away).sum(2)), width)


def _commonest_length(vectors: DataFrame, parts: int) -> int | None:
    sizes = vectors.groupBy(F.size("_vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.where((F.col("size") > 0) & (F.col("size") % parts == 0))
    best = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return best["size"] if best else None


def _finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def compress(
    rows: DataFrame, *, id_col: str, vector_col: str, keep: list[str], parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096
) -> tuple[DataFrame, np.ndarray]:
    """The columns ``keep`` of each row with ``code`` (one byte a part) and ``error`` (its squared distance), and the codebooks.

    At most 256 entries.
    """
    spark = rows.sparkSession
    names = [f"k_{c}" for c in keep]
    vectors = rows.select(*(rows[c].alias(n) for c, n in zip(keep, names)), rows[id_col].alias("_id"), rows[vector_col].cast("array<double>").alias("_vector"))
    vectors = vectors.where(_finite(F.col("_vector")))
    dims = _commonest_length(vectors, parts)
    if dims is None:
        empty = vectors.limit(0).select(*(F.col(n).alias(c) for c, n in zip(keep, names)), F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty, np.zeros((parts, 0, 0), np.int64)
    vectors = vectors.where(F.size("_vector") == dims)
    begin = vectors.select("_id", "_vector").orderBy(F.asc_nulls_last("_id"), "_vector").limit(entries).collect()
    begin = np.clip(np.floor(np.array([r["_vector"] for r in begin], np.float64) * scale), -LIMIT, LIMIT).astype(np.int64)
    start = begin.reshape(len(begin), parts, -1).transpose(1, 0, 2)
    books = Books(start, np.zeros(start.shape[:2], np.float32), min(len(begin) - 1, max(1, len(begin) // 4)))

    kept = vectors.select(*names)
    schema = ", ".join(f"`{n}` {t}" for n, t in kept.dtypes) + (", " if names else "")
    types = kept.limit(0).toArrow().schema
    now, previous = vectors.drop("_id"), None
    for turn in range(rounds):
        work = _pass(spark.sparkContext.broadcast(books), parts, dims, scale, turn == 0, False, names, types)
        done = cut(now.mapInArrow(work, f"{schema}x binary, near binary, bounds binary, sums array<bigint>"), "codes")
        sums = done.where("sums is not null").select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
        sums = sums.toArrow()  # one row for each number of the codebooks
        total = np.zeros(sums.num_rows, np.int64)
        total[sums["at"].to_numpy()] = sums["value"].to_numpy()
        books = _next(books, total)
        if previous is not None:
            release(previous)
        now, previous = done.where("x is not null").drop("sums"), done
    work = _pass(spark.sparkContext.broadcast(books), parts, dims, scale, rounds == 0, True, names, types)
    found = cut(now.mapInArrow(work, f"{schema}code binary, error bigint"), "coded")
    if previous is not None:
        release(previous)
    return found.select(*(F.col(n).alias(c) for c, n in zip(keep, names)), "code", "error"), books.entries


def with_total(rows: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """``rows``, which must be cheap to read twice, with the sum of ``value`` over all rows of equal ``by``; nulls are equal.

    No task gets the rows of a hot group: groups with more than ``HOT_SHARE`` of all rows meet their sums by broadcast.
    """
    own = rows.toDF(*(f"k_{c}" for c in rows.columns))
    sums = cut(own.groupBy(F.col(f"k_{by}").alias("_by")).agg(F.sum(f"k_{value}").alias("_sum"), F.count(F.lit(1)).alias("_n")), "totals")
    most = (sums.agg(F.sum("_n")).first()[0] or 0) * HOT_SHARE
    hot, others = (sums.where(c).drop("_n") for c in (F.col("_n") > most, F.col("_n") <= most))
    same = F.col(f"k_{by}").eqNullSafe(F.col("_by"))
    few = own.join(F.broadcast(hot), same)
    many = own.join(F.broadcast(hot.select("_by")), same, "left_anti").join(others, same)
    return few.unionByName(many).select(*(F.col(f"k_{c}").alias(c) for c in rows.columns), F.col("_sum").alias(name))


@query("op12_codes")
def op12(spark, sf_dir):
    found, books = compress(table(spark, sf_dir, "embeddings"), id_col="vec_id", vector_col="embedding", keep=["vec_id", "label"])
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    found = with_total(found, "label", "error", "label_error")
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
