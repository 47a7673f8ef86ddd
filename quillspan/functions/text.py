"""Text analysis as Spark columns.

A token is a run of letters, marks, digits and underscores, optionally continued
after an apostrophe.  All functions are JVM expressions over one row, so they need
no shuffle and run next to the scan.
"""

from __future__ import annotations

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = r"[\p{L}\p{M}\p{N}_]"
TOKEN_PATTERN = f"{_WORD}++(?:'{_WORD}++)*+"
# A token ends where neither a run nor an apostrophe that joins two runs follows.
_ENDS = f"(?!{_WORD})(?!'{_WORD})"
TOKEN_TYPE = "word"
_MARK = "\u0001"


def query_tokens(text: str) -> list[str]:
    """Tokens of a query text, in order, as the driver needs them to build a plan."""
    return regex.findall(TOKEN_PATTERN, text.lower())


def distinct_in_order(items) -> list:
    return list(dict.fromkeys(items))


def tokens(text: Column) -> Column:
    """Lower-cased tokens of ``text`` in order; an absent text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))


def _starting(term: str) -> str:
    """``term`` where a token starts: no run before it, not even across an apostrophe.

    The term comes first and is looked back over, so that the search skips from find to find.
    """
    return f"{term}(?<!{_WORD}{term})(?<!{_WORD}'{term})"


def any_regex(terms: list[str]) -> str:
    """Finds any of ``terms`` as a whole token of lower-cased text, without tokenizing it."""
    return f"(?:{'|'.join(_starting(t) for t in terms)}){_ENDS}"


def every_regex(terms: list[str]) -> str:
    """Finds a text that has all of ``terms`` as whole tokens."""
    if len(terms) == 1:
        return any_regex(terms)
    return "(?s)^" + "".join(f"(?=.*?{_starting(t)}{_ENDS})" for t in terms)


def run_regex(terms: list[str], last_is_prefix: bool = False) -> str:
    """Finds ``terms`` as neighbouring tokens in this order; the last may be cut short."""
    between = f"{_ENDS}[^\\p{{L}}\\p{{M}}\\p{{N}}_]++"
    return between.join(_starting(t) for t in terms) + ("" if last_is_prefix else _ENDS)


def holds_run(token_array: Column, terms: list[str], last_is_prefix: bool = False) -> Column:
    """Whether ``terms`` are neighbours in an array of tokens.

    Tokens hold no blanks.  Joined so that each owns the blank on both its sides, a run of
    tokens is a plain substring.
    """
    joined = F.concat(F.lit(" "), F.array_join(token_array, "  "), F.lit(" "))
    return joined.contains(" " + "  ".join(terms) + ("" if last_is_prefix else " "))


def term_frequency(token_array: Column, term: str) -> Column:
    return F.size(token_array) - F.size(F.array_remove(token_array, term))


def token_counts(sorted_tokens: str) -> Column:
    """``array<struct<token,tf>>`` of a column of sorted tokens: the lengths of its runs."""
    words = F.col(sorted_tokens)
    starts = F.filter(
        F.transform(words, lambda w, i: F.when((i == 0) | (F.get(words, i - 1) != w), i)), lambda i: i.isNotNull()
    )
    ends = F.concat(F.slice(starts, F.lit(2), F.size(words)), F.array(F.size(words)))
    runs = F.arrays_zip(starts.alias("start"), ends.alias("end"))
    return F.when(
        F.size(words) > 0,
        F.transform(
            runs,
            lambda r: F.struct(F.get(words, r["start"]).alias("token"), (r["end"] - r["start"]).alias("tf")),
        ),
    )


def analyze(text: Column) -> Column:
    """``array<struct<token,start_offset,end_offset,type,position>>`` of ``text``.

    Offsets count code points of the original text; positions start at 1.  A marker is
    put before each token; the k-th marker sits k places right of its token's offset.
    """
    source = F.translate(F.coalesce(text, F.lit("")), _MARK, " ")
    found = F.regexp_extract_all(source, F.lit(TOKEN_PATTERN), F.lit(0))
    marked = F.regexp_replace(source, f"({TOKEN_PATTERN})", _MARK + "$1")
    at = F.filter(
        F.transform(F.split(marked, ""), lambda c, i: F.when(c == _MARK, i)),
        lambda i: i.isNotNull(),
    )
    return F.transform(
        F.arrays_zip(found.alias("token"), at.alias("at")),
        lambda t, k: F.struct(
            F.lower(t["token"]).alias("token"),
            (t["at"] - k).cast("int").alias("start_offset"),
            (t["at"] - k + F.length(t["token"])).cast("int").alias("end_offset"),
            F.lit(TOKEN_TYPE).alias("type"),
            (k + 1).cast("int").alias("position"),
        ),
    )


def edge_ngrams(token_array: Column, min_gram: int = 1, max_gram: int = 20) -> Column:
    """All prefixes of each token with ``min_gram`` to ``max_gram`` characters."""
    long_enough = F.filter(token_array, lambda t: F.length(t) >= min_gram)
    return F.flatten(
        F.transform(
            long_enough,
            lambda t: F.transform(
                F.sequence(F.lit(min_gram), F.least(F.lit(max_gram), F.length(t))),
                lambda n: F.left(t, n),
            ),
        )
    )


ANALYZERS = {"standard": tokens, "edge_ngrams": lambda text: edge_ngrams(tokens(text))}


def analyzed(text: Column, analyzer: str = "standard") -> Column:
    """Tokens of ``text`` under a named analyzer."""
    if analyzer not in ANALYZERS:
        raise ValueError(f"unknown analyzer {analyzer!r}; known: {sorted(ANALYZERS)}")
    return ANALYZERS[analyzer](text)
