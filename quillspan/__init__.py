"""quillspan: searching, counting and maintaining collections of documents on Spark."""

from quillspan.functions.fields import mapped
from quillspan.operators.aggs import (
    agg_ranges,
    agg_terms,
    agg_tree,
    bucket,
    delete_stats,
    fold_hits,
    fold_pages,
    ranges_agg,
    run_aggs,
    split,
    terms_agg,
)
from quillspan.operators.clauses import (
    Clause,
    bool_,
    filtered,
    geo_distance,
    match_all,
    or_filter,
    prefix,
    range_,
    template,
    term,
    terms,
    terms_lookup,
)
from quillspan.operators.documents import bulk_apply_json
from quillspan.operators.fetch import (
    count,
    get,
    hits_count,
    iter_pages,
    multi_get,
    pages,
    unlimited_search,
    write_pages,
)
from quillspan.operators.fulltext import dis_max, match, multi_match, phrase, phrase_prefix, text_query
from quillspan.operators.scoring import ScoreFunction, boosting, function_score
from quillspan.operators.search import SearchResult, matching, search
from quillspan.operators.writes import (
    BulkResult,
    batch_errors,
    bulk_apply,
    delete_by_query,
    merge_attempts,
    upsert,
)
from quillspan.sources.buckets import BucketStore
from quillspan.sources.store import SnapshotRepository, Store, create_index, delete_index

__all__ = [name for name in dir() if not name.startswith("_")]
