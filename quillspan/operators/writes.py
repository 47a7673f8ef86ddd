"""Applying batches of write actions to a collection.

A batch is a DataFrame ``seq, op, _index, _type, _id, payload``; ``seq`` is a unique integer that
gives the order.  ``op`` is one of

* ``index``: ``payload`` is a partial JSON document, merged into the stored one or inserted,
* ``delete``: the document is removed,
* ``script``: ``payload`` names a script that changes an existing document.

All documents of a batch are applied before all deletes, and those before all scripts,
whatever their order in the batch; inside a phase ``seq`` decides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan.operators.aggs import delete_stats
from quillspan.operators.clauses import Clause
from quillspan.operators.search import predicate
from quillspan.plans.durable import materialize
from quillspan.plans.runs import CHUNK, by_heat, last_before, running_sum, split_hot

KEY = ["_index", "_type", "_id"]
ACTION_SCHEMA = "seq bigint, op string, _index string, _type string, _id string, payload string"
RESULT_COLUMNS = ["seq", *KEY, "_version", "status", "found", "error"]
FIRST_ERROR_STATUS = 400
BACK_PRESSURE_STATUS = 429
RETRY_LIMIT = 5
# Scripts of one document are applied this many per round, so no array grows with the batch.
SCRIPTS_PER_ROUND = 100_000
_BASE = -(1 << 63)

Script = Callable[[Column], dict[str, Column]]


@dataclass(frozen=True)
class BulkResult:
    """``docs``: the collection after the batch; ``results``: one row per action."""

    docs: DataFrame
    results: DataFrame


def filled(*columns: Column) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(c != "", F.lit(False)) for c in columns])


def _one_object(text: Column) -> Column:
    """Whether ``text`` is one strict JSON object and nothing else.

    Parsers stop after the first value, so text behind it only shows inside brackets: it would have
    to continue both an array and an object.  Names that occur twice and nesting beyond Spark's
    limit (1000 levels) are refused.
    """
    listed = F.concat(F.lit("["), text, F.lit("]"))
    named = F.concat(F.lit('{"p":'), text, F.lit("}"))
    alone = (F.json_array_length(listed) == 1) & (F.size(F.json_object_keys(named)) == 1)
    return F.json_object_keys(text).isNotNull() & F.try_parse_json(listed).isNotNull() & alone


def valid_action() -> Column:
    """Keys and, but for deletes, the payload are there; a document payload is a JSON object."""
    key = filled(*[F.col(k) for k in KEY])
    payload = filled(F.col("payload"))
    document = payload & _one_object(F.col("payload"))
    return key & (
        (F.col("op") == "delete") | ((F.col("op") == "script") & payload) | ((F.col("op") == "index") & document)
    )


def _result(df: DataFrame, version: Column, status: Column, found=None, error=None) -> DataFrame:
    return df.select(
        "seq",
        *KEY,
        version.cast("bigint").alias("_version"),
        status.cast("int").alias("status"),
        (found if found is not None else F.lit(None)).cast("boolean").alias("found"),
        (error if error is not None else F.lit(None)).cast("string").alias("error"),
    )


def _paths(shape: T.StructType, above: tuple = ()):
    """Every field as ``(path, type)``, a struct before the fields in it."""
    for field in shape:
        path = (*above, field.name)
        yield path, field.dataType
        if isinstance(field.dataType, T.StructType):
            yield from _paths(field.dataType, path)


def _dig(path: tuple, root: Column | None = None) -> Column:
    value, rest = (F.col(path[0]), path[1:]) if root is None else (root, path)
    return reduce(lambda v, name: v.getField(name), rest, value)


def _as_map(text: Column) -> Column:
    return F.from_json(text, "map<string,string>")


def _patches(shape: T.StructType) -> tuple[list[Column], Column, Column]:
    """What a payload, read as ``_named`` (a map) and ``_read`` (by ``shape``), does to each path: ``struct<v>``
    where it sets it, else NULL.

    Objects merge field by field: the ``v`` of a struct says whether it is there, its fields have paths of their
    own, and a null for a struct is a null for all of them.  Also whether a value does not fit its column, and
    the names that are no columns.
    """
    parsed, level = F.col("_read"), {(): F.col("_named")}
    emptied = {(): F.lit(False)}
    patches, misfit = [], F.lit(False)

    def strangers(path: tuple, fields: T.StructType) -> Column:
        known = F.array(*map(F.lit, fields.names)).cast("array<string>")
        names = F.coalesce(F.array_except(F.map_keys(level[path]), known), F.array().cast("array<string>"))
        above = "".join(f"{name}." for name in path)
        return F.transform(names, lambda n: F.concat(F.lit(above), n))

    unknown = [strangers((), shape)]
    for path, data_type in _paths(shape):
        above, name = path[:-1], path[-1]
        named = F.coalesce(F.map_contains_key(level[above], name), F.lit(False))
        raw, value = level[above][name], _dig(path, parsed)
        misfit = misfit | (named & raw.isNotNull() & value.isNull())
        given = F.when(named, value)
        if isinstance(data_type, T.StructType):
            given = named & raw.isNotNull()
            level[path] = _as_map(raw)
            emptied[path] = emptied[above] | (named & raw.isNull())
            unknown.append(strangers(path, data_type))
        patches.append(F.when(emptied[above] | named, F.struct(given.alias("v"))))
    return patches, misfit, F.array_sort(F.concat(*unknown))


def bulk_apply(
    current: DataFrame,
    actions: DataFrame,
    scripts: dict[str, Script] | None = None,
    chunk: int = CHUNK,
    cut: Callable[[DataFrame], DataFrame] | None = None,
) -> BulkResult:
    """Apply a batch to typed documents ``_index, _type, _id, _version, <columns>``.

    A document payload sets the columns it names, fields of struct columns one by one; an explicit null
    overwrites.  A value that does not fit its column rejects the action (status 400); names that are
    no columns change nothing and are listed in ``error`` of the result.  ``seq`` may be any
    number above the least bigint.  Values and versions run along a key in pieces by ``seq``; untouched
    documents pass by unshuffled when the set of touched keys is small enough for Spark to broadcast it.
    """
    columns = [c for c in current.columns if c not in (*KEY, "_version")]
    shape = T.StructType([current.schema[c] for c in columns])
    paths = list(_paths(shape))
    patches, misfit, unknown = _patches(shape)
    fits = ~((F.col("op") == "index") & misfit)
    notes = F.when(F.size(unknown) > 0, F.concat(F.lit("unknown fields: "), F.array_join(unknown, ", ")))
    is_document = F.col("op") == "index"
    checked = actions.select(
        "*",
        F.coalesce(valid_action(), F.lit(False)).alias("_well_formed"),
        F.when(is_document, _as_map(F.col("payload"))).alias("_named"),
        F.when(is_document, F.from_json("payload", shape)).alias("_read"),
    )
    checked = checked.withColumn("_valid", F.col("_well_formed") & F.coalesce(fits, F.lit(True))).withColumn(
        "_error", F.when(~F.col("_well_formed"), F.lit("invalid action")).otherwise(F.lit("value does not fit its column"))
    )
    # Payloads are read once, here; every later step sees what they do, not their text.
    takes = is_document & F.col("_valid")
    checked = materialize(
        checked.select(
            "seq",
            "op",
            *KEY,
            F.when(F.col("op") == "script", F.col("payload")).alias("payload"),
            "_valid",
            F.when(~F.col("_valid"), F.col("_error")).alias("_error"),
            F.when(takes, notes).alias("_note"),
            *[F.when(takes, p).alias(f"_p_{i}") for i, p in enumerate(patches)],
        ),
        "actions",
    )
    valid = checked.where("_valid")
    documents = valid.where(is_document).select(
        "seq",
        *KEY,
        F.lit(None).cast("bigint").alias("_version"),
        F.lit(True).alias("_alive"),
        "_note",
        *[f"_p_{i}" for i in range(len(patches))],
    )
    touched = valid.select(*KEY).distinct()
    stored = current.join(touched, KEY, "left_semi").select(
        F.lit(_BASE).cast("bigint").alias("seq"),
        *KEY,
        "_version",
        F.lit(True).alias("_alive"),
        F.lit(None).cast("string").alias("_note"),
        *[
            F.struct((_dig(p).isNotNull() if isinstance(t, T.StructType) else _dig(p)).alias("v")).alias(f"_p_{i}")
            for i, (p, t) in enumerate(paths)
        ],
    )
    values = [f"_p_{i}" for i in range(len(paths))]
    is_action = F.col("seq") != _BASE
    differs = [F.col(v).isNotNull() & ~F.col(v)["v"].eqNullSafe(F.col(f"_old{v}")["v"]) for v in values]
    changed = F.col("_was_alive").isNull() | reduce(lambda a, b: a | b, differs, F.lit(False))
    # A stored document enters with its version, every effective action adds one.
    step = F.when(is_action, changed.cast("bigint")).otherwise(F.col("_version"))
    earlier = {"_was_alive": F.col("_alive"), **{f"_old{v}": F.col(v) for v in values}}

    def follow(rows: DataFrame, pieces: int | None) -> DataFrame:
        history = last_before(rows, KEY, "seq", earlier, pieces)
        return running_sum(history, KEY, "seq", {"_now": step}, pieces)

    hot = split_hot(valid, KEY, chunk)
    versioned = by_heat(stored.unionByName(documents), KEY, hot, chunk, follow).select(
        "seq", *KEY, "_now", F.col("_was_alive").isNull().alias("_created"), "_note", *values
    )
    versioned = cut(versioned) if cut else versioned
    created = F.col("_created")
    document_results = _result(
        versioned.where(is_action),
        F.col("_now"),
        F.when(created, F.lit(201)).otherwise(F.lit(200)),
        error=F.col("_note"),
    )

    latest = versioned.groupBy(*KEY).agg(
        F.max("_now").alias("_version"),
        *[F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.col("seq")))["v"].alias(v) for v in values],
    )
    place = {path: v for (path, _), v in zip(paths, values)}

    def whole(data_type: T.DataType, path: tuple) -> Column:
        if not isinstance(data_type, T.StructType):
            return F.col(place[path])
        return F.when(
            F.col(place[path]), F.struct(*[whole(f.dataType, (*path, f.name)).alias(f.name) for f in data_type])
        )

    latest = latest.select(*KEY, "_version", *[whole(f.dataType, (f.name,)).alias(f.name) for f in shape])
    return _finish(current, checked, touched, latest, document_results, columns, scripts or {}, hot, chunk)


def _finish(
    current: DataFrame,
    checked: DataFrame,
    touched: DataFrame,
    latest: DataFrame,
    document_results: DataFrame,
    columns: list[str],
    scripts: dict[str, Script],
    hot: DataFrame | None,
    chunk: int,
) -> BulkResult:
    """Deletes and scripts on ``latest``, the touched documents as they are after phase one."""
    valid = checked.where("_valid")
    rejected = _result(
        checked.where(~F.col("_valid")), F.lit(None), F.lit(FIRST_ERROR_STATUS), error=F.col("_error")
    )
    deletes = valid.where(F.col("op") == "delete")
    first_delete = deletes.groupBy(*KEY).agg(F.min("seq").alias("_first"))
    alive = latest.select(*KEY, F.col("_version").alias("_stored"))
    hit = first_delete.join(alive, KEY, "left")
    # The left side may hold many deletes of one key; one row per key is on the right, and
    # the adaptive skew join splits the left.
    removed = deletes.join(hit, KEY, "left")
    gone = (F.col("seq") == F.col("_first")) & F.col("_stored").isNotNull()
    delete_results = _result(
        removed,
        F.when(gone, F.col("_stored") + 1),
        F.when(gone, F.lit(200)).otherwise(F.lit(404)),
        found=gone,
    )

    kept = latest.join(first_delete.select(*KEY), KEY, "left_anti")
    script_actions = valid.where(F.col("op") == "script")
    known = F.col("payload").isin(list(scripts)) if scripts else F.lit(False)
    targets = kept.select(*KEY, F.col("_version").alias("_stored"))
    nth = {"_nth": F.col("_known").cast("bigint")}
    numbered = by_heat(
        script_actions.withColumn("_known", known),
        KEY,
        hot,
        chunk,
        lambda rows, pieces: running_sum(rows, KEY, "seq", nth, pieces),
    )
    tried = numbered.join(targets, KEY, "left")
    there = F.col("_stored").isNotNull()
    script_results = _result(
        tried,
        F.when(there & F.col("_known"), F.col("_stored") + F.col("_nth")),
        F.when(~F.col("_known"), F.lit(400)).when(there, F.lit(200)).otherwise(F.lit(404)),
        error=F.when(~F.col("_known"), F.lit("unknown script")).when(~there, F.lit("document missing")),
    )
    if scripts:
        usable = numbered.where("_known").select(*KEY, "seq", "payload", "_nth")
        kept = run_scripts(kept, usable, columns, scripts)

    untouched = current.join(touched, KEY, "left_anti")
    docs = untouched.unionByName(kept.select(*current.columns))
    results = rejected.unionByName(document_results).unionByName(delete_results).unionByName(script_results)
    return BulkResult(docs, results)


def run_scripts(docs: DataFrame, calls: DataFrame, columns: list[str], scripts: dict[str, Script]) -> DataFrame:
    """Fold the named scripts of each document, in order, into its columns.

    ``calls`` has the key, ``seq``, ``payload`` (a script name) and ``_nth``, the 1-based place of the
    call among those of its document.  A script may be any expression, so the calls of one
    document can only run one after another; they do so in rounds, each of which joins the
    documents with arrays of at most ``SCRIPTS_PER_ROUND`` calls.
    """
    most = calls.agg(F.max("_nth")).first()[0]
    if most is None:
        return docs
    types = {c: docs.schema[c].dataType for c in columns}

    def whole(changes: dict[str, Column], state: Column) -> Column:
        unknown = set(changes) - set(columns)
        if unknown:
            raise ValueError(f"a script sets unknown columns {sorted(unknown)}")
        return F.struct(*[changes.get(c, state[c]).cast(types[c]).alias(c) for c in columns])

    def call_one(state: Column, call: Column) -> Column:
        after = state
        for name, script in scripts.items():
            after = F.when(call["payload"] == name, whole(script(state), state)).otherwise(after)
        return after

    def play(state_of: DataFrame, some_calls: DataFrame) -> DataFrame:
        lists = some_calls.groupBy(*KEY).agg(
            F.array_sort(F.collect_list(F.struct("seq", "payload"))).alias("_calls")
        )
        called = state_of.join(lists, KEY, "left").withColumn("_calls", F.coalesce("_calls", F.array()))
        state = F.struct(*[F.col(c).alias(c) for c in columns])
        return called.withColumn("_state", F.aggregate("_calls", state, call_one)).select(
            *KEY,
            (F.col("_version") + F.size("_calls")).alias("_version"),
            *[F.col("_state")[c].alias(c) for c in columns],
        )

    if most <= SCRIPTS_PER_ROUND:
        return play(docs, calls)
    # Only the documents with calls left over take part in further rounds.
    first = materialize(play(docs, calls.where(F.col("_nth") <= SCRIPTS_PER_ROUND)), "scripts")
    later = materialize(calls.where(F.col("_nth") > SCRIPTS_PER_ROUND), "calls")
    waiting = later.select(*KEY).distinct()
    done = first.join(waiting, KEY, "left_anti")
    active = first.join(waiting, KEY, "left_semi")
    for start in range(SCRIPTS_PER_ROUND, most, SCRIPTS_PER_ROUND):
        turn = later.where((F.col("_nth") > start) & (F.col("_nth") <= start + SCRIPTS_PER_ROUND))
        active = materialize(play(active, turn), "scripts")
    return done.unionByName(active)


def upsert(current: DataFrame, index: str, type_name: str, id_value: str, doc: str) -> BulkResult:
    """Insert or merge one document; an empty argument gives a rejected action, not an error."""
    action = current.sparkSession.createDataFrame(
        [(0, "index", index, type_name, id_value, doc)], ACTION_SCHEMA
    )
    return bulk_apply(current, action)


def has_error(status: Column) -> Column:
    return status >= FIRST_ERROR_STATUS


def batch_errors(results: DataFrame) -> DataFrame:
    """One row ``errors``: whether any final result of the batch is an error."""
    return results.agg(F.coalesce(F.bool_or(has_error(F.col("status"))), F.lit(False)).alias("errors"))


def merge_attempts(log: DataFrame, keys: list[str], max_attempts: int = RETRY_LIMIT) -> DataFrame:
    """The final result of every action from a log of attempts ``<keys>, attempt, status, ...``.

    Only rejected actions (status 429) are sent again, at most ``max_attempts`` times in all, so
    the first other status stands, or else the last rejection.  An attempt whose call failed
    as a whole has no status and changes nothing.  Plain grouping with partial aggregates.
    """
    rest = [c for c in log.columns if c not in keys]
    row = F.struct(*rest)
    counted = log.where((F.col("attempt") <= max_attempts) & F.col("status").isNotNull())
    settled = F.when(F.col("status") != BACK_PRESSURE_STATUS, F.col("attempt"))
    return (
        counted.groupBy(*keys)
        .agg(F.coalesce(F.min_by(row, settled), F.max_by(row, F.col("attempt"))).alias("_final"))
        .select(*keys, "_final.*")
    )


def delete_by_query(
    current: DataFrame, query: Clause | list | None = None, index_col: str = "_index"
) -> tuple[DataFrame, DataFrame]:
    """``(survivors, stats)`` of deleting the documents that match, by default all.

    Survivors are a filter of the collection: nothing is shuffled.
    """
    doomed = predicate(current, query)
    stats = delete_stats(current.where(doomed).withColumn("status", F.lit(200)), index_col)
    return current.where(~doomed), stats
