"""Write batches on collections that keep each document as JSON text.

Same batches and outcomes as :mod:`quillspan.operators.writes`, for documents
``_index, _type, _id, _version, _source``.  Objects merge recursively, scalars and arrays are
replaced, an explicit null overwrites.  Numbers keep their spelling; lone surrogates become ``?``.

Merging JSON trees is the one step without built-in functions.  It runs as a fold over sorted
partitions, Arrow batch by Arrow batch, holding one document at a time.  A document with
more than ``chunk`` actions is folded in ranges of at most ``chunk`` of them: each range is first
reduced to one combined patch, the patches give the state in which every range starts, then
all ranges are replayed side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspan.operators.writes import _BASE, KEY, BulkResult, _finish, _result, valid_action
from quillspan.plans.runs import by_heat, chunked, running_sum, split_hot

DOCUMENT_CHUNK = 50_000
_KEY_DDL = "_index string, _type string, _id string"


def _sorted_fold(df: DataFrame, group: list[str], order: str, step, schema: str) -> DataFrame:
    """Fold rows in ``order`` within each group; ``step(state, row, last)`` gives (state, row or None).

    The state starts as ``None``.  Groups may span Arrow batches; ``last`` tells that the row ends
    its group.
    """
    names = [field.split()[0] for field in schema.split(", ")]

    def fold(batches):
        import pandas as pd

        def rows():
            for batch in batches:
                yield from batch.to_dict("records")
            yield None

        state, held, out = None, None, []
        for row in rows():
            if held is not None:
                last = row is None or any(held[g] != row[g] for g in group)
                state, made = step(state, held, last)
                if last:
                    state = None
                if made is not None:
                    out.append(made)
                if len(out) >= 10_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            held = row
        if out:
            yield pd.DataFrame(out, columns=names)

    ordered = df.repartition(*group).sortWithinPartitions(*group, order)
    return ordered.mapInPandas(fold, schema)


def _tree_functions():
    """JSON helpers as one closure, so that workers need nothing installed."""
    import json
    import sys
    from decimal import Decimal, InvalidOperation

    class Whole(str):
        """A number as it is spelled."""

    class Real(str):
        """A number with a fraction or an exponent, as it is spelled."""

    def load(text):
        # Payloads nest up to 1000 levels, and a level takes up to two calls; this runs in the worker.
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 10_000))
        return json.loads(text, parse_int=Whole, parse_float=Real)

    def spelled(value):
        if isinstance(value, (Whole, Real)):
            return str(value)
        if isinstance(value, dict):
            return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{spelled(v)}" for k, v in value.items()) + "}"
        if isinstance(value, list):
            return "[" + ",".join([spelled(v) for v in value]) + "]"
        return json.dumps(value, ensure_ascii=False)

    def dump(value):
        return spelled(value).encode("utf-8", "replace").decode()

    def number(text):
        try:
            return Decimal(text)
        except InvalidOperation:  # an exponent beyond any decimal
            return str(text)

    def same(a, b):
        if isinstance(a, (Whole, Real)):
            return type(a) is type(b) and number(a) == number(b)
        if isinstance(a, dict) and isinstance(b, dict):
            return a.keys() == b.keys() and all(same(a[k], b[k]) for k in a)
        if isinstance(a, list) and isinstance(b, list):
            return len(a) == len(b) and all(same(x, y) for x, y in zip(a, b))
        return type(a) is type(b) and a == b

    # A patch is {"set": value} or {"merge": {key: patch}}.
    def as_patch(value):
        if isinstance(value, dict):
            return {"merge": {k: as_patch(v) for k, v in value.items()}}
        return {"set": value}

    def patched(value, patch):
        if "set" in patch:
            return patch["set"]
        out = dict(value) if isinstance(value, dict) else {}
        for k, p in patch["merge"].items():
            out[k] = patched(out.get(k), p)
        return out

    def joined(first, second):
        if "set" in second:
            return second
        if "set" in first:
            return {"set": patched(first["set"], second)}
        out = dict(first["merge"])
        for k, p in second["merge"].items():
            out[k] = joined(out[k], p) if k in out else p
        return {"merge": out}

    return load, dump, same, as_patch, patched, joined


def bulk_apply_json(
    current: DataFrame, actions: DataFrame, scripts=None, chunk: int = DOCUMENT_CHUNK, cut=None
) -> BulkResult:
    """Apply a batch of actions to JSON documents; scripts see and set ``_source``."""
    load, dump, same, as_patch, patched, joined = _tree_functions()
    checked = actions.withColumn("_valid", F.coalesce(valid_action(), F.lit(False))).withColumn(
        "_error", F.lit("invalid action")
    )
    valid = checked.where("_valid")
    touched = valid.select(*KEY).distinct()
    documents = valid.where(F.col("op") == "index").select(
        *KEY, "seq", "payload"
    )
    stored = current.join(touched, KEY, "left_semi")

    def combine(patch, row, last):
        one = as_patch(load(row["payload"]))
        patch = one if patch is None else joined(patch, one)
        if not last:
            return patch, None
        return patch, [row["_index"], row["_type"], row["_id"], row["_chunk"], dump(patch)]

    def carry(state, row, last):
        before = dump(state[0]) if state else None
        patch = load(row["payload"])
        state = [patched(state[0] if state else {}, patch)]
        return state, [row["_index"], row["_type"], row["_id"], row["_chunk"], before]

    def replay(state, row, last):
        if row["seq"] == _BASE:
            return [load(row["payload"])], None
        before = state[0] if state else None
        after = patched(before if state else {}, as_patch(load(row["payload"])))
        changed = not state or not same(before, after)
        return [after], [
            row["_index"], row["_type"], row["_id"], row["seq"], not state, changed, dump(after) if last else None
        ]

    replayed_ddl = f"{_KEY_DDL}, seq bigint, _created boolean, _changed boolean, _source string"
    patch_ddl = f"{_KEY_DDL}, _chunk bigint, payload string"
    opening = stored.select(
        *KEY, F.lit(_BASE).cast("bigint").alias("seq"), F.col("_source").alias("payload")
    )

    def follow(rows: DataFrame, pieces: int | None) -> DataFrame:
        if pieces is None:
            return _sorted_fold(rows, KEY, "seq", replay, replayed_ddl)
        ours = chunked(rows.where(F.col("seq") != _BASE), KEY, "seq", pieces)
        combined = _sorted_fold(ours, [*KEY, "_chunk"], "seq", combine, patch_ddl)
        whole = F.concat(F.lit('{"set":'), "payload", F.lit("}")).alias("payload")
        first = rows.where(F.col("seq") == _BASE).select(*KEY, F.lit(_BASE).cast("bigint").alias("_chunk"), whole)
        starts = _sorted_fold(first.unionByName(combined), KEY, "_chunk", carry, patch_ddl).where(
            (F.col("_chunk") != _BASE) & F.col("payload").isNotNull()
        )
        opened = starts.withColumn("seq", F.lit(_BASE).cast("bigint")).unionByName(ours)
        return _sorted_fold(opened, [*KEY, "_chunk"], "seq", replay, replayed_ddl)

    hot = split_hot(valid, KEY, chunk)
    replayed = by_heat(opening.unionByName(documents), KEY, hot, chunk, follow)
    history = replayed.withColumn("_version", F.lit(None).cast("bigint")).unionByName(
        stored.select(
            *KEY,
            F.lit(_BASE).cast("bigint").alias("seq"),
            F.lit(False).alias("_created"),
            F.lit(False).alias("_changed"),
            "_source",
            "_version",
        )
    )
    is_action = F.col("seq") != _BASE
    step = F.when(is_action, F.col("_changed").cast("bigint")).otherwise(F.col("_version"))
    versioned = by_heat(
        history, KEY, hot, chunk, lambda rows, pieces: running_sum(rows, KEY, "seq", {"_now": step}, pieces)
    )
    versioned = versioned.select("seq", *KEY, "_now", "_created", "_source")
    versioned = cut(versioned) if cut else versioned
    document_results = _result(
        versioned.where(is_action), F.col("_now"), F.when(F.col("_created"), F.lit(201)).otherwise(F.lit(200))
    )
    latest = versioned.groupBy(*KEY).agg(
        F.max("_now").alias("_version"),
        F.max_by("_source", F.when(F.col("_source").isNotNull(), F.col("seq"))).alias("_source"),
    )
    return _finish(current, checked, touched, latest, document_results, ["_source"], scripts or {}, hot, chunk)
