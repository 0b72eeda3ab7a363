"""Token counts by rank-synchronous merging of ragged arrays.

Defined results: a null text counts as empty (0 bytes, 0 tokens); special
strings inside a text are one token each, as the library treats them; repeated
rows give repeated results; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from kiln.llm.bpe import merges, pre_tokens, special_strings
from kiln.llm.common import map_texts

MEMO = 500_000                      # pre-tokens remembered by a worker; only saves repeated work
_seen: dict[str, dict[str, int]] = {}   # by vocabulary file


def count_tokens(texts: list[str], path: str, memo: dict[str, int]) -> list[int]:
    """Tokens of each text; new pre-tokens of all texts are merged together."""
    special = special_strings(path)
    lists: list[list[list[str]]] = []
    base: list[int] = []
    for text in texts:
        parts = special.split(text) if special else [text]
        base.append(len(parts) - 1)
        lists.append([p for part in parts if part for p in pre_tokens(part, path)])
    unseen = list({t for own in lists for part in own for t in part}.difference(memo))
    if len(memo) + len(unseen) > MEMO:
        memo.clear()
        unseen = list({t for own in lists for part in own for t in part})
    memo.update(zip(unseen, merges(path).count([t.encode() for t in unseen]).tolist(), strict=True))
    return [n + sum(sum(map(memo.__getitem__, part)) for part in own) for n, own in zip(base, lists, strict=True)]


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; ``path`` names a byte-level BPE file."""

    def run(texts: list[str]) -> dict:
        counts = count_tokens(texts, path, _seen.setdefault(path, {}))
        return {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": counts,
                "over_limit": [n > limit for n in counts]}

    return map_texts(docs, text_col, {id_col: id_col},
                     {"n_bytes": "long", "n_tokens": "long", "over_limit": "boolean"}, run, chars=2_000_000)
