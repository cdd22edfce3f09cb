"""Column builders: search predicates (F1-F9), text match and scalar helpers."""

from eventide.functions.predicates import (bool_query, exists, match_all, must, must_not,
                                           range_between, term, terms)
from eventide.functions.scalars import (concat_ids, epoch_ms, from_epoch_ms, json_number,
                                        parse_json)
from eventide.functions.text import match, match_pattern, tokens

__all__ = [
    "bool_query", "exists", "match_all", "must", "must_not", "range_between", "term", "terms",
    "concat_ids", "epoch_ms", "from_epoch_ms", "json_number", "parse_json",
    "match", "match_pattern", "tokens",
]
