"""Byte-pair encoding by a trie of last-token states, and decoding."""

from __future__ import annotations

import hashlib
import json
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from homespan.llm.text import rows_of

#: Units (words with the space before them) in each of a worker's tables, and judged token pairs, at most.
MAX_UNITS = 150_000
MAX_PAIRS = 80_000
_NEVER = (-1, b"", b"")
_UNITS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: Letters that every Unicode version since 1.1 has; other letters are left to the library's splitter.
_SIMPLE = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ȗ]+)([.,!?;:|]*)")


def split_units(text: str) -> list[str]:
    """Cut a text where a piece always ends: before a space or line end that follows a character that is no space.

    Pieces never cross such a place, so each unit can be encoded on its own. Anything that Python calls a space
    counts as one, which covers all that the splitter calls so.
    """
    out: list[str] = []
    for unit in _UNITS.findall(text):
        if out and out[-1][-1].isspace():
            out[-1] += unit
        else:
            out.append(unit)
    return out


def _is_plain(piece: str) -> bool:
    """No space at either end, but for one line end at the front."""
    head = piece[1:] if piece[:1] == "\n" else piece
    return bool(head) and not head[0].isspace() and not head[-1].isspace()


class UnitCache:
    """Encodings of units by their text. Texts are cut and their distinct units found column-wise; unusual spacing goes slower."""

    def __init__(self, encode_units, newline: bytes, most: int = MAX_UNITS):
        self.encode_units, self.newline, self.most = encode_units, newline, most
        self.heads: dict[str, bytes] = {}  # as they stand
        self.spaced: dict[str, bytes] = {}  # with a space before; those that begin with a line end as they stand
        self.odd: dict[str, bytes] = {}

    def _learn(self, table: dict[str, bytes], keys: list[str], prefix: str) -> None:
        if keys:
            table.update(zip(keys, self.encode_units([prefix + k for k in keys] if prefix else keys)))

    def clear_if_full(self) -> None:
        for table in (self.heads, self.spaced, self.odd):
            if len(table) > self.most:  # the older half goes; what is frequent comes back at once
                for key in list(islice(table, len(table) // 2)):
                    del table[key]

    def _codes(self, pieces: list[str]) -> list[bytes | None]:
        """Codes of pieces that follow a space or begin with a line end; None where the neighbours matter."""
        codes = list(map(self.spaced.get, pieces))
        new = [p for p, c in zip(pieces, codes) if c is None and _is_plain(p)]
        if new:
            lines = [p for p in new if p[0] == "\n"]
            self._learn(self.spaced, [p for p in new if p[0] != "\n"], " ")
            self._heads([p[1:] for p in lines])
            self.spaced.update((p, self.newline + self.heads[p[1:]]) for p in lines)
            codes = [self.spaced.get(p) if c is None else c for p, c in zip(pieces, codes)]
        return codes

    def _heads(self, pieces: list[str]) -> None:
        self._learn(self.heads, list({p for p in pieces if p not in self.heads}), "")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, as bytes; unknown units of all the texts are encoded together."""
        self.clear_if_full()
        if not texts:
            return []
        cut = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        ends, coded = cut.offsets.to_numpy()[1:], cut.values.dictionary_encode()
        starts = np.append(0, ends[:-1])
        pieces, index = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        codes = self._codes(pieces)
        first = [pieces[i] for i in index[starts].tolist()]
        self._heads([p for p in first if _is_plain(p) and p[0] != "\n"])
        index[starts] = np.arange(len(codes), len(codes) + len(first))
        codes += [self.spaced.get(p) if p[:1] == "\n" else self.heads.get(p) for p in first]
        known = np.array([c is not None for c in codes])
        sizes = np.array([len(c) // 4 if c else 0 for c in codes])
        pool = np.frombuffer(b"".join([c for c in codes if c]), "<u4")
        own, of_unit = np.cumsum(sizes) - sizes, sizes[index]
        upto = np.cumsum(of_unit)
        ids = pool[np.repeat(own[index] - (upto - of_unit), of_unit) + np.arange(upto[-1])]
        plain = np.logical_and.reduceat(known[index], starts)
        ids_end = upto[ends - 1]
        ids_start = np.append(0, ids_end[:-1])
        return [ids[a:b].tobytes() if p else self._carefully(t)
                for t, p, a, b in zip(texts, plain.tolist(), ids_start.tolist(), ids_end.tolist())]

    def _carefully(self, text: str) -> bytes:
        units = split_units(text)
        self._learn(self.odd, sorted(set(units) - self.odd.keys()), "")
        return b"".join(map(self.odd.__getitem__, units))


class TrieBpe:
    """Encoder and decoder of a byte-level BPE tokenizer file.

    Encoding a prefix of a word ends in exactly one token t, and removing t leaves the encoding of a shorter prefix
    whose last token may stand before t: two tokens may if their joined bytes encode to just these two. So a trie
    node needs only the last token of its prefix, which follows from the states on the path above it, is computed once,
    and serves all words with that prefix.
    """

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.to_byte = _byte_of_character()
        raw = lambda token: bytes(self.to_byte[c] for c in token)
        self.rank: dict[tuple[bytes, bytes], int] = {}
        self.made_by: dict[bytes, tuple[int, bytes, bytes]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            left, right = raw(left), raw(right)
            self.rank[left, right] = rank
            self.made_by[left + right] = (rank, left, right)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (1 + max([*model["vocab"].values(), *self.special.values()]))
        self.id_of = {}
        for token, n in model["vocab"].items():
            if token not in self.special:
                self.bytes_of[n] = raw(token)
                self.id_of[raw(token)] = n.to_bytes(4, "little")
        for content, n in self.special.items():
            self.bytes_of[n] = content.encode()
        self.decimal = [b"%d" % n for n in range(len(self.bytes_of))]
        self.longest = max(map(len, self.id_of))
        self.may_follow: dict[tuple[bytes, bytes], bool] = {}
        self.splitter = None
        self.path = path
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.cache = UnitCache(self._encode_units, self._depth_first([b"\n"])[b"\n"])

    def _merged(self, raw: bytes) -> list[bytes]:
        """Encode a few bytes by merging; used only to judge tokens and pairs of tokens."""
        parts = [raw[i: i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            ranks = [self.rank.get(p, len(self.rank)) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == len(self.rank):
                break
            i = ranks.index(best)
            parts[i: i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _allowed(self, before: bytes, token: bytes) -> bool:
        """Whether the joined bytes of two tokens encode to just these two (or those of one token to itself).

        Undo the merges of both tokens, the latest first. If at some point the two parts at the seam have a merge of
        their own that comes before the one undone last, that merge would have joined them; else the seam holds. Of
        equal merges the left one comes first.
        """
        known = self.may_follow.get((before, token))
        if known is not None:
            return known
        if len(self.may_follow) > MAX_PAIRS:
            self.may_follow.clear()
        if not before:
            known = self._merged(token) == [token]
        else:
            left, right, undone, known = before, token, len(self.rank), None
            while known is None:
                own = self.rank.get((left, right))
                one, two = self.made_by.get(left, _NEVER), self.made_by.get(right, _NEVER)
                if own is not None and own < undone:
                    known = False
                elif one[0] > two[0]:
                    undone, left = one[0], one[2]
                elif two[0] >= 0:
                    undone, right = two[0] + 1, two[1]
                else:
                    known = True
        self.may_follow[before, token] = known
        return known

    def _depth_first(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Encodings of distinct pieces, by walking their trie depth first.

        Sorted order is the trie's depth-first order: two neighbours share the path up to their common prefix. ``states``
        holds the last tokens along the current path, so each trie node is computed once, for all pieces below it.
        """
        ids, judged, longest, allowed = self.id_of, self.may_follow, self.longest, self._allowed
        out, states, previous = {}, [b""], b""
        for raw in sorted(pieces):
            shared = 0
            for one, other in zip(raw, previous):
                if one != other:
                    break
                shared += 1
            del states[shared + 1:]
            for i in range(shared + 1, len(raw) + 1):
                for start in range(i - longest if i > longest else 0, i):
                    token = raw[start:i]
                    if token in ids:
                        before = states[start]
                        fits = judged.get((before, token))
                        if fits or fits is None and allowed(before, token):
                            states.append(token)
                            break
            parts, i = [], len(raw)
            while i:
                parts.append(ids[states[i]])
                i -= len(states[i])
            out[raw] = b"".join(parts[::-1])
            previous = raw
        return out

    def _pieces(self, unit: str) -> list[bytes]:
        simple = _SIMPLE.fullmatch(unit)
        if simple:
            core, tail = simple.groups()
            return [core.encode(), tail.encode()] if tail else [core.encode()]
        if self.splitter is None:
            from tokenizers import Tokenizer

            self.splitter = Tokenizer.from_file(self.path).pre_tokenizer
        return [bytes(self.to_byte[c] for c in piece) for piece, _ in self.splitter.pre_tokenize_str(unit)]

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """Encode distinct units by way of their distinct pieces."""
        cut = [self._pieces(u) for u in units]
        known = self._depth_first(list({p for pieces in cut for p in pieces}))
        return [known[pieces[0]] if len(pieces) == 1 else b"".join(map(known.__getitem__, pieces)) for pieces in cut]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; null counts as empty. Special tokens spelled out in a text get their own id."""
        texts = [t or "" for t in texts]
        marked = {i for i, t in enumerate(texts) if self.special_pattern and self.special_pattern.search(t)}
        packed = self.cache.encode(["" if i in marked else t for i, t in enumerate(texts)])
        for i in marked:
            packed[i] = b"".join(self.special[part].to_bytes(4, "little") if part in self.special else self.cache.encode([part])[0]
                                 for part in self.special_pattern.split(texts[i]))
        return [np.frombuffer(p, "<u4") for p in packed]

    def decode(self, ids) -> str:
        """Text of any ids; bytes that are no UTF-8 become replacement characters, ids outside the vocabulary nothing."""
        table, n = self.bytes_of, len(self.bytes_of)
        return b"".join([table[i] for i in map(int, ids) if 0 <= i < n]).decode("utf-8", "replace")


def _byte_of_character() -> dict[str, int]:
    """Byte-level alphabets write printable bytes as themselves and the others as characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


_encoders: dict[str, TrieBpe] = {}


def encoder(path: str) -> TrieBpe:
    """The worker's encoder of a tokenizer file; words known from earlier tasks stay known."""
    if path not in _encoders:
        _encoders[path] = TrieBpe(path)
    return _encoders[path]


def encoded(text: Column, path: str) -> Column:
    """Ids of a text column as an array of ints; a null text gives an empty array."""
    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        found = [a for rows in rows_of(texts, 1024) for a in encoder(path).encode(rows)]
        offsets = np.concatenate(([0], np.cumsum([len(a) for a in found]))).astype(np.int32)
        values = np.concatenate(found).astype(np.int32) if found else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

    return ids.asNondeterministic()(text)


def decoded(ids: Column, path: str) -> Column:
    """Text of a column of id arrays; a null array gives null."""
    @F.arrow_udf("string")
    def texts(arrays: pa.Array) -> pa.Array:
        return pa.array([None if a is None else encoder(path).decode(a) for a in arrays.to_pylist()], pa.string())

    return texts.asNondeterministic()(ids)


def digests(text: Column, path: str) -> Column:
    """Struct of n_tokens and SHA-256 digests of the ids and of the text decoded from them, without carrying the ids along."""
    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(texts: pa.Array) -> pa.Array:
        bpe, counts, of_ids, of_texts = encoder(path), [], [], []
        for rows in rows_of(texts, 1024):
            for ids in bpe.encode(rows):
                ids = ids.tolist()
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(b",".join(map(bpe.decimal.__getitem__, ids))).hexdigest())
                of_texts.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                                           pa.array(of_texts, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest.asNondeterministic()(text)
