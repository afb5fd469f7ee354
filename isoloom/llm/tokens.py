"""Whole-text encoding with a tokenizers file, remembered word by word."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

#: Begins a piece that is taken as it stands; a piece without it follows one space.
MARK = "\x01"
#: White space of any kind; two in a row, or a MARK, need more care than a split at spaces.
_SPACE = "\t-\r \x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CAREFUL = f"[{_SPACE}][{_SPACE}]|{MARK}"
_CUT = re.compile(r"(?<=\S)(?=[ \n\t])")
#: Up to here all Unicode versions agree about what is a letter.
_LATIN = "\u024f"
#: Ends of words that are one token to both patterns, whatever letters stand before them.
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: A letter up to _LATIN and one of _TAIL after it: both patterns cut between them.
_BEFORE_TAIL = "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f])([!-&(-/:-@\\[-`{-~])"
#: The pre-tokenizer pattern of the second kind (fixed value).
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
#: The character that byte-level vocabularies have for each byte: itself if it is printable, else the next from 256 on.
_BYTES = {b: chr(b if b in _SHOWN else 256 + sum(x not in _SHOWN for x in range(b))) for b in range(256)}


class Encoder:
    """Encodes texts to unsigned 32-bit ids, equal to those of encoding whole texts.

    A text is cut where its tokenizer always starts a new token, each distinct
    piece of some rows is encoded once, and what it encodes to is remembered.
    Two kinds are known, both byte-level BPE: without normaliser, where one space
    belongs to the word after it, and with words cut by _WORDS and white space
    dropped. Texts of other tokenizers are encoded whole. At most twice ``limit`` pieces of up to
    ``longest`` characters are held; those not met for long go first.
    """

    def __init__(self, path: str, limit: int = 100_000, longest: int = 48):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        pre = spec.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers") or [{}]
        bytewise = not spec.get("truncation") and not spec.get("padding") and spec["model"].get("type") == "BPE"
        self.kind = "whole"
        if bytewise and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space"):
            self.kind = "joined"
        elif bytewise and [x.get("type") for x in steps] == ["Split", "ByteLevel"] and steps[0]["pattern"] == {"Regex": _WORDS} and steps[0]["invert"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]:
            self.kind = "dropped" if spec.get("normalizer") and not self._raw([" \n "])[0] else "whole"
        self.added = tuple(t["content"] for t in spec.get("added_tokens") or ())
        self.careful = "|".join(map(re.escape, self.added))
        #: Whether pieces of letters and _TAIL alone can hold no added token.
        self.simple = not any(_letters(t.rstrip(_TAIL)) for t in self.added)
        self.sizes = byte_lengths(self.tokenizer, spec["model"].get("end_of_word_suffix") or "") if self.kind != "whole" else None
        #: The model alone, for pre-tokens on lines.
        self.lines = Tokenizer(self.tokenizer.model)
        self.lines.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        self.limit, self.longest = limit, longest
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, piece: str) -> str | None:
        """Pre-tokens of a piece in byte letters, one a line; None if it holds an added token."""
        head = ""
        if self.kind == "dropped":
            raw, text = piece, (piece.lower() if piece.isascii() else self.tokenizer.normalizer.normalize_str(piece))
            piece = text
        elif piece[:1] == MARK:
            text = piece = piece[1:]
        elif piece == "\n":
            return "\u010a"
        else:
            head, text = "\u0120", " " + piece
        word = piece.rstrip(_TAIL)
        if self.simple and _letters(word):
            tail = piece[len(word) :]
            if not word.isascii():
                word = word.encode("utf-8").decode("latin-1").translate(_BYTES)
            return f"{head}{word}\n{tail}" if word and tail else f"{head}{word}{tail}"
        if any(t in (raw if self.kind == "dropped" else text) for t in self.added):
            return None
        return "\n".join([x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)])

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece, from one call of the model for all of them."""
        parts = [self._parts(x) for x in pieces]
        out: list[bytes] = []
        for i in range(0, len(parts), 4096):
            some = [x or "" for x in parts[i : i + 4096]]
            ids = np.asarray(self.lines.encode_batch_fast(["\n".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum([len(x) - x.count("\n") for x in some])
            cut = (4 * np.searchsorted(np.cumsum(self.sizes[ids]), ends, "right")).tolist()
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *cut[:-1]], cut)]
        for i in [i for i, x in enumerate(parts) if x is None]:
            at = pieces[i]
            out[i] = self._raw([at[1:] if at[:1] == MARK else at if self.kind == "dropped" else " " + at])[0]
        return out

    def _lists(self, texts: pa.StringArray) -> tuple[np.ndarray, pa.StringArray]:
        """Number of pieces of each text, and all pieces."""
        if self.kind == "dropped":
            spaced = pc.replace_substring(texts, "\n", " ")
            lists = pc.split_pattern(pc.ascii_lower(pc.replace_substring_regex(spaced, _BEFORE_TAIL, r"\1 \2")), " ")
            care = pc.match_substring_regex(texts, self.careful) if self.added else pa.array(np.zeros(len(texts), bool))
            slow = [t.split(" ") for t in spaced.filter(care).to_pylist()]
        else:
            apart = pc.replace_substring_regex(pc.replace_substring(texts, "\n", f" \n {MARK}"), _BEFORE_TAIL, rf"\1 {MARK}\2")
            lists = pc.split_pattern(pc.binary_join_element_wise(MARK, apart, ""), " ")
            care = pc.match_substring_regex(texts, "|".join((_CAREFUL, self.careful)) if self.added else _CAREFUL)
            slow = [[MARK + x for x in _CUT.split(t)] for t in texts.filter(care).to_pylist()]
        if slow:
            lists = _mixed(lists, care, pa.array(slow, pa.list_(pa.string())))
        return pc.list_value_length(lists).to_numpy(), lists.flatten()

    def flat(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of an Arrow column one after the other, and where each text's end. A null text has none."""
        texts = pc.fill_null(column, "")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        if self.kind == "whole":
            got = self._raw(texts.to_pylist())
            return np.frombuffer(b"".join(got), "<u4"), np.cumsum([len(x) // 4 for x in got], dtype=np.int64)
        pieces, found = self._lists(texts)
        coded = found.dictionary_encode()
        at = coded.indices.to_numpy()
        got = self._ids(_strings(coded.dictionary))
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        pool = np.frombuffer(b"".join(got), "<u4")
        n = size[at]
        ends = np.cumsum(n)
        ids = pool[np.repeat((np.cumsum(size) - size)[at] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate(([0], ends))[np.cumsum(pieces, dtype=np.int64)]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        memo, older = self.memo, self.older
        out = [memo.get(x) for x in pieces]
        rest = [i for i, x in enumerate(out) if x is None]
        for i in rest:
            out[i] = older.get(pieces[i])
        new = [i for i in rest if out[i] is None]
        for i, ids in zip(new, self._encode([pieces[i] for i in new])):
            out[i] = ids
        for i in rest:
            if len(pieces[i]) <= self.longest:
                if len(self.memo) >= self.limit:
                    self.memo, self.older = {}, self.memo
                self.memo[pieces[i]] = out[i]
        return out

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, little-endian."""
        ids, ends = self.flat(pa.array(texts, pa.string()))
        raw = ids.astype("<u4").tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _mixed(lists, care, slow):
    """lists, with the slow ones in their places where care is."""
    mask = care.to_numpy(zero_copy_only=False)
    at = np.where(mask, len(lists) + np.cumsum(mask) - 1, np.arange(len(lists)))
    return pa.concat_arrays([lists, slow.cast(lists.type)]).take(pa.array(at))


def _letters(word: str) -> bool:
    """Whether a word is empty or of letters that all Unicode versions agree about."""
    return not word or word.isalpha() and (word.isascii() or max(word) <= _LATIN)


def _strings(column: pa.StringArray) -> list[str]:
    """to_pylist() of strings without nulls, from one decoding of them all."""
    text = pc.binary_join(pa.ListArray.from_arrays([0, len(column)], column), "")[0].as_py()
    ends = np.cumsum(pc.utf8_length(column).to_numpy(), dtype=np.int64).tolist()
    return [text[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def byte_lengths(tokenizer: Tokenizer, suffix: str = "") -> np.ndarray:
    """Bytes of each id of a byte-level vocabulary: a token has one character a byte."""
    vocab = tokenizer.get_vocab()
    out = np.zeros(max(vocab.values()) + 1, np.int64)
    for token, i in vocab.items():
        out[i] = len(token.removesuffix(suffix))
    return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's own encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_parts(column: pa.Array, path: str, rows: int = 2048, size: int = 8 << 20):
    """Yields (first row, ids, ends) for an Arrow text column: up to ``rows`` rows at a
    time, and no more than ``size`` bytes unless one text alone is longer."""
    enc = encoder(path)
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    i = 0
    while i < len(column):
        most = (ends[i - 1] if i else 0) + size
        n = min(rows, max(1, int(np.searchsorted(ends, most, "right")) - i))
        yield (i, *enc.flat(column.slice(i, n)))
        i += n


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and ends of texts with end_id after each."""
    if end_id is None:
        return ids, ends
    return np.insert(ids, ends, np.uint32(end_id)), ends + np.arange(1, len(ends) + 1)


def binary_slices(ids: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """Ids between successive ends, little-endian."""
    offsets = np.concatenate(([0], ends)) * ids.itemsize
    if offsets[-1] >= 1 << 31:
        raise ValueError("a text has too many ids for one value")
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))])
