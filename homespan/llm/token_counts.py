"""Token counts by the whole-token shortcut.

Before any text is read, every vocabulary string is encoded alone by the tokenizer library; those that come out as
exactly one token form the *whole* set. That is a proof, not a guess: one token means one pre-token, and byte-pair
merges inside a pre-token never look outside it, so wherever that string stands as a pre-token of a text it is one
token. Counting then cuts each text into units at places where a pre-token always ends (a space or line end after a
character that is no space), looks a unit up in a per-task table, and only for a unit never seen before asks the
library's pre-tokenizer for its pieces: a piece in the whole set counts one, the rest go through the model's merges.
Texts that hold an added special string (``<|endoftext|>``) are handed to the library whole, which treats such strings
as its default does.

Tokenizer files ending in ``.model`` are sentencepiece models, which have no pre-tokens of this kind; they are counted
by the library directly.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: Units remembered per task, and the longest unit worth remembering (longer ones are rare and would only fill it).
MAX_UNITS = 1_000_000
#: Texts whose new units are gathered and sent to the library together.
ROWS_AT_ONCE = 256
#: A unit boundary: before a space or line end that follows a character that is no space (Python's ``isspace`` is a
#: superset of every regex engine's white space, so such a place always ends a pre-token).
_UNIT_CUT = re.compile(r"(?<=[^\s])(?=[ \n])")
#: A space that follows white space: only then is a plain cut at every space not a cut at pre-token ends.
_SPACE_AFTER_SPACE = re.compile(r"\s ")
#: Texts are cut into windows of about this many characters at unit boundaries, so a huge text never makes a huge list.
_WINDOW = 1 << 20
_counters: dict[str, "TokenCounter"] = {}


def whole_token_strings(tokenizer) -> dict[str, str]:
    """Vocabulary strings that the library encodes alone as exactly their own single token: text by vocabulary piece."""
    from tokenizers import decoders

    decoder = decoders.ByteLevel()
    vocab = tokenizer.get_vocab()
    pieces = sorted(vocab, key=vocab.__getitem__)
    texts = [decoder.decode([p]) for p in pieces]
    kept = [(p, t) for p, t in zip(pieces, texts) if t and "�" not in t]
    encoded = tokenizer.encode_batch([t for _, t in kept], add_special_tokens=False)
    return {p: t for (p, t), e in zip(kept, encoded) if e.ids == [vocab[p]]}


class TokenCounter:
    """Counts tokens of texts as the library would, by units and the whole-token set."""

    def __init__(self, path: str):
        self.path = path
        if path.endswith(".model"):
            import sentencepiece

            self.piece = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        from tokenizers import Tokenizer

        self.piece = None
        self.tok = Tokenizer.from_file(path)
        config = json.loads(self.tok.to_str())
        pre = config.get("pre_tokenizer") or {}
        #: The unit cut is proven for the byte-level splitter only; another file is counted by the library text by text.
        self.by_units = (config.get("normalizer") is None and pre.get("type") == "ByteLevel"
                         and pre.get("use_regex", True) and not pre.get("add_prefix_space", False))
        added = config.get("added_tokens", [])
        self.specials = [t["content"] for t in added]
        plain = [t for t in added if not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized"))
                 and _overlaps_no_shift(t["content"])]
        self.separator, self.separator_id = (plain[0]["content"], plain[0]["id"]) if plain else ("", -1)
        self.whole = set(whole_token_strings(self.tok).values())
        #: Counts of units as they stand, and of pieces that follow a space (the unit is " " + piece).
        self.units: dict[str, int] = {}
        self.spaced: dict[str, int] = {}

    def _learn(self, table: dict[str, int], keys: set[str], prefix: str) -> None:
        """Count new units: a whole token counts one at once; only the rest are merged by the library.

        The rest go in one call, joined by the first added special string: the library cuts its input at such strings
        before anything else, so each unit is encoded as if alone, and the tokens between two separators are its own.
        (No unit holds that string, and it overlaps no shift of itself, so no unit's end can run into a separator.)
        """
        whole = self.whole
        rest = [k for k in keys if prefix + k not in whole]
        table.update((k, 1) for k in keys if prefix + k in whole)
        if not rest:
            return
        if not self.separator:
            encoded = self.tok.encode_batch_fast([prefix + k for k in rest], add_special_tokens=False)
            table.update((k, len(e.ids)) for k, e in zip(rest, encoded))
            return
        joined = self.separator.join(prefix + k for k in rest) + self.separator
        ids = np.asarray(self.tok.encode_batch_fast([joined], add_special_tokens=False)[0].ids)
        ends = np.flatnonzero(ids == self.separator_id)
        table.update(zip(rest, (np.diff(ends, prepend=-1) - 1).tolist()))

    def _cut(self, text: str) -> tuple[str, object]:
        if not self.by_units or any(s in text for s in self.specials):
            return "whole", text
        if len(text) <= _WINDOW and not _SPACE_AFTER_SPACE.search(text):
            head, *pieces = text.split(" ")
            return "spaced", (head, pieces)
        return "units", [u for start in range(0, len(text), _WINDOW)
                         for u in _UNIT_CUT.split(text[_cut_at(text, start): _cut_at(text, start + _WINDOW)])]

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text (null or empty: 0)."""
        if self.piece is not None:
            return [len(self.piece.encode(t)) if t else 0 for t in texts]
        for table in (self.units, self.spaced):
            if len(table) > MAX_UNITS:
                table.clear()
        cut = [self._cut(t) if t else ("none", None) for t in texts]
        heads = {d[0] for k, d in cut if k == "spaced"}
        units = set().union(*(d for k, d in cut if k == "units"), heads)
        pieces = set().union(*(d[1] for k, d in cut if k == "spaced"))
        self._learn(self.units, units.difference(self.units), "")
        self._learn(self.spaced, pieces.difference(self.spaced), " ")
        units_of, spaced_of, out = self.units.__getitem__, self.spaced.__getitem__, []
        for kind, d in cut:
            if kind == "spaced":
                out.append(units_of(d[0]) + sum(map(spaced_of, d[1])))
            elif kind == "units":
                out.append(sum(map(units_of, d)))
            elif kind == "whole":
                out.append(len(self.tok.encode_batch_fast([d], add_special_tokens=False)[0].ids))
            else:
                out.append(0)
        return out

    def count(self, text: str | None) -> int:
        return self.counts([text])[0]


def _overlaps_no_shift(s: str) -> bool:
    """No proper prefix of ``s`` is also its suffix."""
    return bool(s) and not any(s[:k] == s[-k:] for k in range(1, len(s)))


def _cut_at(text: str, at: int) -> int:
    """The first unit boundary at or after ``at`` (or the text's end)."""
    if at <= 0:
        return 0
    found = _UNIT_CUT.search(text, at)
    return found.start() if found else len(text)


def counter(path: str) -> TokenCounter:
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def n_tokens(text: Column, path: str) -> Column:
    """Tokens of each text (null or empty: 0), as a long column."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task; the library must not spin up more
        c = counter(path)
        for texts in batches:
            out = []
            for start in range(0, len(texts), ROWS_AT_ONCE):
                out += c.counts(texts.iloc[start: start + ROWS_AT_ONCE].tolist())
            yield pd.Series(out, dtype="int64")

    return count(text)


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` with n_bytes (UTF-8 bytes of the text), n_tokens and over_limit (n_tokens > ``limit``).

    Every row stays, in any order, repeats included. A null or empty text has 0 bytes and 0 tokens; texts of any
    length are counted whole. Input columns named n_bytes, n_tokens or over_limit are replaced.
    """
    counted = docs.withColumn("n_tokens", n_tokens(F.col(text), path))
    return counted.withColumns({
        "n_bytes": F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long"),
        "over_limit": F.col("n_tokens") > F.lit(limit),
    })
