"""Counting documents by value and by range."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspan.functions.fields import field_column, is_array
from quillspan.functions.rows import unnest

DEFAULT_BUCKETS = 10
RANK_PARTS = 64
ORDERS = [(by, way) for by in ("count", "key") for way in ("asc", "desc")]


@dataclass(frozen=True)
class TermsAgg:
    """One bucket per value of ``field``, largest first; an array counts once per distinct value.

    ``order`` is ``("count" | "key", "asc" | "desc")``, equal counts by key; ``include`` and ``exclude`` list values.
    """

    field: str
    size: int = DEFAULT_BUCKETS
    order: tuple[str, str] = ("count", "desc")
    min_doc_count: int = 1
    include: tuple | None = None
    exclude: tuple = ()

    def __post_init__(self):
        if self.order not in ORDERS:
            raise ValueError(f"order must be one of {ORDERS}")

    def wants(self, value: Column) -> Column | None:
        """Whether a value may be a bucket; ``None`` if all may."""
        if self.include is None and not self.exclude:
            return None
        among = value.isin(list(self.include)) if self.include is not None else F.lit(True)
        return among & ~value.isin(list(self.exclude)) if self.exclude else among


@dataclass(frozen=True)
class Bucket:
    """Values from ``from_`` (inclusive) to ``to`` (exclusive); either may be open."""

    key: str
    from_: object = None
    to: object = None

    def holds(self, value: Column) -> Column:
        tests = []
        if self.from_ is not None:
            tests.append(value >= F.lit(self.from_))
        if self.to is not None:
            tests.append(value < F.lit(self.to))
        return reduce(lambda a, b: a & b, tests)


def bucket(key: str, from_=None, to=None) -> Bucket | None:
    """A range bucket, or ``None`` if it has no bound."""
    return None if from_ is None and to is None else Bucket(key, from_, to)


@dataclass(frozen=True)
class RangesAgg:
    """Named, possibly overlapping ranges of one field; empty ones are reported with 0."""

    field: str
    buckets: tuple

    def __post_init__(self):
        object.__setattr__(self, "buckets", tuple(b for b in self.buckets if b is not None))


def agg_terms(
    field: str, size: int = DEFAULT_BUCKETS, order=("count", "desc"), min_doc_count: int = 1, include=None, exclude=()
) -> TermsAgg:
    return TermsAgg(field, size, tuple(order), min_doc_count, None if include is None else tuple(include), tuple(exclude))


def agg_ranges(field: str, buckets: list[Bucket | None]) -> RangesAgg:
    return RangesAgg(field, tuple(buckets))


def _first(df: DataFrame, by: list[str], order: list[Column], key: str, size: int) -> DataFrame:
    """The ``size`` first rows of each group with their ``_rank``.

    Every group is ranked in ``RANK_PARTS`` parts dealt by ``key``, then the best of the parts among each other, so the
    last task of a group sees ``size`` rows a part, however many keys the group has.
    """
    part = F.pmod(F.xxhash64(key), F.lit(RANK_PARTS))
    rank = F.row_number().over(W.partitionBy(*by, "_part").orderBy(*order))
    best = df.withColumn("_part", part).withColumn("_rank", rank).where(F.col("_rank") <= size).drop("_part")
    return best.withColumn("_rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_rank") <= size)


def _bucket_order(order: tuple[str, str], count: str, key: str) -> list[Column]:
    by, way = order
    last = F.col(key).desc() if order == ("key", "desc") else F.col(key).asc()
    return [last] if by == "key" else [F.col(count).asc() if way == "asc" else F.col(count).desc(), last]


def _one_order(aggs: dict, which: Column, key: Column) -> tuple[Column, Column]:
    """One order for several aggregations: counts with the sign of their direction, then keys that run down."""
    place, down = -F.col("doc_count"), F.lit(None).cast("string")
    for name, agg in aggs.items():
        order = agg.order if isinstance(agg, TermsAgg) else ("count", "desc")
        if order != ("count", "desc"):
            here = which == name
            place = F.when(here, F.col("doc_count") if order[0] == "count" else F.lit(0)).otherwise(place)
            down = F.when(here, key).otherwise(down) if order == ("key", "desc") else down
    return place, down


def distinct_values(field: str) -> Column:
    """The distinct non-NULL values of an array field."""
    return F.array_distinct(F.array_compact(F.col(field)))


def run_aggs(df: DataFrame, aggs: dict[str, TermsAgg | RangesAgg]) -> DataFrame:
    """All aggregations in one pass and one shuffle: rows ``agg, key, doc_count``.

    Each document lists the buckets it falls into; the list is counted with partial sums
    before the shuffle.  Keys are shown as text and ordered so; ties go to the smaller key.
    """
    entries = F.concat(*[_entries(df, name, agg) for name, agg in aggs.items()])
    counted = unnest(df.select(entries.alias("_a")), "_a", "_e").select(
        "_e.agg", "_e.key", F.lit(1).cast("bigint").alias("n")
    )
    empty = [
        (name, b.key, 0) for name, agg in aggs.items() if isinstance(agg, RangesAgg) for b in agg.buckets
    ]
    if empty:
        counted = counted.union(df.sparkSession.createDataFrame(empty, "agg string, key string, n bigint"))
    sums = counted.groupBy("agg", "key").agg(F.sum("n").alias("doc_count"))
    sizes = {name: agg.size if isinstance(agg, TermsAgg) else len(agg.buckets) for name, agg in aggs.items()}
    bars = {n: a.min_doc_count for n, a in aggs.items() if isinstance(a, TermsAgg) and a.min_doc_count > 1}
    for name, least in bars.items():
        sums = sums.where((F.col("agg") != name) | (F.col("doc_count") >= least))
    place, down = _one_order(aggs, F.col("agg"), F.col("key"))
    top = _first(sums, ["agg"], [place.asc(), down.desc(), F.col("key").asc()], "key", max(sizes.values()))
    if len(set(sizes.values())) > 1:
        limit = F.lit(None).cast("int")
        for name, size in sizes.items():
            limit = F.when(F.col("agg") == name, F.lit(size)).otherwise(limit)
        top = top.where(F.col("_rank") <= limit)
    return top.drop("_rank")


def _entries(df: DataFrame, name: str, agg: TermsAgg | RangesAgg) -> Column:
    """``array<struct<agg,key>>`` of one document."""
    def entry(key: Column) -> Column:
        return F.struct(F.lit(name).alias("agg"), key.cast("string").alias("key"))

    if isinstance(agg, RangesAgg):
        value = _number(df, agg.field, agg.buckets)
        held = [F.when(b.holds(value), entry(F.lit(b.key))) for b in agg.buckets]
        return F.array_compact(F.array(*held)) if held else F.array().cast("array<struct<agg:string,key:string>>")
    return F.coalesce(
        F.transform(_values(df, agg), entry), F.array().cast("array<struct<agg:string,key:string>>")
    )


def _values(df: DataFrame, agg: TermsAgg) -> Column:
    """The values of one document that may be buckets."""
    values = (
        distinct_values(agg.field) if is_array(df, agg.field) else F.array_compact(F.array(field_column(df, agg.field)))
    )
    return values if agg.wants(F.lit(0)) is None else F.filter(values, agg.wants)


def terms_agg(
    df: DataFrame,
    field: str,
    size: int = DEFAULT_BUCKETS,
    metrics: dict[str, Column] | None = None,
    sub: TermsAgg | None = None,
    sum_other: bool = False,
    order: tuple[str, str] = ("count", "desc"),
    min_doc_count: int = 1,
    include=None,
    exclude=(),
) -> DataFrame:
    """Buckets ``key, doc_count`` of one field with its own type; options as of :class:`TermsAgg`.

    ``metrics`` adds aggregate columns per bucket; ``sub`` splits each top bucket again
    (``sub_key, sub_doc_count``, metrics then per sub-bucket); ``sum_other`` adds the number of
    documents counted in buckets that did not make the list, of the values that may be buckets.
    """
    metrics = {k: v for k, v in (metrics or {}).items()}
    agg = agg_terms(field, size, order, min_doc_count, include, exclude)
    rows = _keyed(df, agg, "key")
    enough = F.col("doc_count") >= agg.min_doc_count
    ranked = _bucket_order(agg.order, "doc_count", "key")
    if sub is None:
        counted = rows.groupBy("key").agg(
            F.count(F.lit(1)).alias("doc_count"), *[m.alias(n) for n, m in metrics.items()]
        )
        top = (counted.where(enough) if agg.min_doc_count > 1 else counted).orderBy(*ranked).limit(size)
        if not sum_other:
            return top
        weight = F.size(distinct_values(field)) if is_array(df, field) else F.lit(1)
        if agg.wants(F.lit(0)) is None:
            given = df.where(field_column(df, field).isNotNull())
        else:
            given, weight = rows, F.lit(1)
        everything = given.agg(F.sum(weight.cast("bigint")).alias("n")).scalar()
        listed = F.sum("doc_count").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        return top.withColumn("sum_other_doc_count", everything - listed)

    heads = (
        rows.groupBy("key")
        .agg(F.count(F.lit(1)).alias("doc_count"))
        .where(enough)
        .orderBy(*ranked)
        .limit(size)
    )
    cells = _keyed(rows, sub, "sub_key").groupBy("key", "sub_key").agg(
        F.count(F.lit(1)).alias("sub_doc_count"), *[m.alias(n) for n, m in metrics.items()]
    )
    of_heads = cells.join(heads, "key").where(F.col("sub_doc_count") >= sub.min_doc_count)
    first = _first(of_heads, ["key"], _bucket_order(sub.order, "sub_doc_count", "sub_key"), "sub_key", sub.size)
    return first.select("key", "doc_count", "sub_key", "sub_doc_count", *metrics)


def _keyed(df: DataFrame, agg: TermsAgg, name: str) -> DataFrame:
    if is_array(df, agg.field):
        rows = unnest(df, distinct_values(agg.field), name)
    else:
        value = field_column(df, agg.field)
        rows = df.where(value.isNotNull()).withColumn(name, value)
    wanted = agg.wants(F.col(name))
    return rows if wanted is None else rows.where(wanted)


@dataclass(frozen=True)
class Split:
    """A level of a tree of aggregations: every bucket of ``by`` is split again by each of ``subs``."""

    name: str
    by: TermsAgg | RangesAgg
    subs: tuple = ()


def split(name: str, by: TermsAgg | RangesAgg, *subs: Split) -> Split:
    if "/" in name:
        raise ValueError("the name of a split has no /")
    return Split(name, by, subs)


METRICS = {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg, "count": F.count}


def agg_tree(df: DataFrame, splits: list[Split], metrics: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Aggregations inside the buckets of others, to any depth: rows ``agg, path, doc_count, <metrics>``.

    ``agg`` joins the names from the root by ``/``, ``path`` holds the bucket's keys from the root as text. ``metrics``
    maps a name to a function of :data:`METRICS` and a field, computed for every bucket. A terms level keeps its first
    ``size`` buckets inside each kept bucket above; ranges keep all, empty ones with 0, below every bucket that is kept.

    Each document lists the paths it falls into (with arrays on several levels, all their combinations), and all levels are
    counted in one pass with partial sums. Buckets are ranked among their siblings, a large family in parts, and stay
    if all above them stay, which one join of what is left with its own ancestors decides.
    """
    nodes: dict[str, tuple[Split, str]] = {}

    def enter(node: Split, above: str) -> None:
        name = f"{above}/{node.name}" if above else node.name
        if name in nodes:
            raise ValueError(f"two splits are called {name}")
        nodes[name] = (node, above)
        for sub in node.subs:
            enter(sub, name)

    for root in splits:
        enter(root, "")
    shape = "array<struct<agg:string,path:array<string>,n:bigint>>"
    nothing = F.array().cast(shape)

    def listed(node: Split, above: str, path: Column) -> Column:
        name = f"{above}/{node.name}" if above else node.name

        def with_subs(key: Column, n: Column, inside: Column | None) -> Column:
            longer = F.concat(path, F.array(key.cast("string")))
            own = F.array(F.struct(F.lit(name).alias("agg"), longer.alias("path"), n.cast("bigint").alias("n"))).cast(shape)
            subs = [listed(sub, name, longer) for sub in node.subs]
            return F.concat(own, *(s if inside is None else F.when(inside, s).otherwise(nothing) for s in subs))

        if isinstance(node.by, RangesAgg):
            value = _number(df, node.by.field, node.by.buckets)
            held = [(b.key, F.coalesce(b.holds(value), F.lit(False))) for b in node.by.buckets]
            return F.concat(nothing, *(with_subs(F.lit(key), inside, inside) for key, inside in held))
        return F.coalesce(F.flatten(F.transform(_values(df, node.by), lambda v: with_subs(v, F.lit(1), None))), nothing)

    start = F.array().cast("array<string>")
    measured = {name: (METRICS[kind], field_column(df, field)) for name, (kind, field) in (metrics or {}).items()}
    rows = df.select(
        F.concat(nothing, *(listed(root, "", start) for root in splits)).alias("_a"),
        *(value.alias(f"_m_{i}") for i, (_, value) in enumerate(measured.values())),
    )
    rows = unnest(rows, "_a", "_e").select("_e.agg", "_e.path", "_e.n", *(c for c in rows.columns if c != "_a"))
    empty = [(name, [b.key]) for name, (node, above) in nodes.items() if not above and isinstance(node.by, RangesAgg) for b in node.by.buckets]
    if empty:
        zero = df.sparkSession.createDataFrame(empty, "agg string, path array<string>").withColumn("n", F.lit(0).cast("bigint"))
        rows = rows.unionByName(zero, allowMissingColumns=True)
    counts = F.col("n") > 0
    cells = rows.groupBy("agg", "path").agg(
        F.sum("n").alias("doc_count"),
        *(made(F.when(counts, F.col(f"_m_{i}"))).alias(name) for i, (name, (made, _)) in enumerate(measured.items())),
    )
    bys = {name: node.by for name, (node, _) in nodes.items()}
    limit = least = F.lit(None).cast("int")
    for name, by in bys.items():
        here = F.col("agg") == name
        limit = F.when(here, by.size if isinstance(by, TermsAgg) else len(by.buckets)).otherwise(limit)
        least = F.when(here, by.min_doc_count if isinstance(by, TermsAgg) else 0).otherwise(least)
    key = F.element_at("path", -1)
    place, down = _one_order(bys, F.col("agg"), key)
    family = cells.where(F.col("doc_count") >= least).withColumn("_above", F.slice("path", F.lit(1), F.size("path") - 1))
    largest = max((by.size if isinstance(by, TermsAgg) else len(by.buckets) for by in bys.values()), default=0)
    top = _first(family, ["agg", "_above"], [place.asc(), down.desc(), key.asc()], "path", largest)
    top = top.where(F.col("_rank") <= limit).drop("_rank", "_above")
    if all(not above for _, above in nodes.values()):
        return top
    steps = F.split("agg", "/")
    up = F.transform(
        F.sequence(F.lit(1), F.size("path")),
        lambda i: F.struct(F.array_join(F.slice(steps, 1, i), "/").alias("agg"), F.slice("path", F.lit(1), i).alias("path")),
    )
    asked = top.select("agg", "path", F.explode(up).alias("_up")).select("agg", "path", F.col("_up.agg").alias("_agg"), F.col("_up.path").alias("_path"))
    there = top.select(F.col("agg").alias("_agg"), F.col("path").alias("_path"))
    whole = asked.join(there, ["_agg", "_path"]).groupBy("agg", "path").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == F.size("path"))
    return top.join(whole.select("agg", "path"), ["agg", "path"], "left_semi")


def _number(df: DataFrame, field: str, buckets) -> Column:
    """A field to be put into ranges; one inside JSON documents is read as the bounds' type."""
    bounds = [v for b in buckets for v in (b.from_, b.to) if v is not None]
    return field_column(df, field, bounds[0] if bounds else None)


def ranges_agg(df: DataFrame, field: str, buckets: list[Bucket | None]) -> DataFrame:
    """Rows ``key, doc_count`` for every range, all counted in one global aggregate."""
    kept = [b for b in buckets if b is not None]
    value = _number(df, field, kept)
    counts = df.agg(*[F.count_if(b.holds(value)).alias(f"c{i}") for i, b in enumerate(kept)])
    rows = F.array(
        *[F.struct(F.lit(b.key).alias("key"), F.col(f"c{i}").alias("doc_count")) for i, b in enumerate(kept)]
    )
    return counts.select(F.inline(rows))


def fold_pages(pages: DataFrame) -> DataFrame:
    """One row per ``search_id`` from its result pages.

    ``pages`` has ``search_id, page_no, took, total, max_score, aggregations, error, status``.
    Times add up, totals and scores take their largest, aggregations their first that is not
    empty; the first failed page, if any, is the outcome instead.
    """
    has_aggs = F.col("aggregations").isNotNull() & ~F.col("aggregations").isin("", "{}")
    folded = pages.groupBy("search_id").agg(
        F.sum("took").cast("bigint").alias("took"),
        F.max("total").cast("bigint").alias("total"),
        F.max("max_score").alias("max_score"),
        F.min_by("aggregations", F.when(has_aggs, F.col("page_no"))).alias("aggregations"),
        F.min_by(F.struct("error", "status"), F.when(F.col("error").isNotNull(), F.col("page_no"))).alias("_failed"),
    )
    failed = F.col("_failed").isNotNull()

    def unless_failed(name):
        return F.when(~failed, F.col(name)).alias(name)

    return folded.select(
        "search_id",
        F.when(failed, "error").otherwise("ok").alias("outcome"),
        *[unless_failed(n) for n in ("took", "total", "max_score", "aggregations")],
        F.col("_failed.error").alias("error"),
        F.col("_failed.status").alias("status"),
    )


def fold_hits(pages: DataFrame) -> DataFrame:
    """The hits of all pages of the searches that did not fail, as rows in page order.

    ``pages`` also has ``hits``, an array of structs.  ``page_no, pos`` give the order; nothing is
    collected into one row.
    """
    failed = pages.where(F.col("error").isNotNull()).select("search_id").distinct()
    hits = unnest(pages.join(failed, "search_id", "left_anti"), "hits", "_hit", position="pos")
    return hits.select("search_id", "page_no", "pos", "_hit.*")


def delete_stats(deleted: DataFrame, index_col: str = "_index") -> DataFrame:
    """Per index: documents meant to be deleted, deleted and not deleted."""
    return deleted.groupBy(index_col).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") < 400).alias("successful"),
        F.count_if(F.col("status") >= 400).alias("failed"),
    )
