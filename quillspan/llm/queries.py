"""Importing this module registers the queries of this folder."""

from quillspan.llm import (  # noqa: F401
    codes,
    decontaminate,
    html_text,
    language,
    licenses,
    lmscore,
    mixing,
    neardup,
    pieces,
    quality,
    resample,
    substrings,
    tokens,
)
from quillspan.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
