"""Token ids of many texts at once by a public tokenizer, each distinct piece of text encoded once.

Where a text may be cut without changing its ids is read from the tokenizer's own settings, see
``cutting``. Pieces are split and numbered by Arrow, their ids gathered by one numpy index.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from linkrisk.llm.common import remembered

#: Bytes that each of the two generations of remembered pieces may take in a worker, and what an entry takes besides its strings.
REMEMBERED, ENTRY = 40_000_000, 150
#: Bytes of text whose pieces are looked at together.
TOGETHER = 4_000_000
_CUT = "\x01"
#: The only two ways of making tokens from text whose tokens ``parts`` knows beforehand.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_LOWER_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
#: Latin letters that have one lower-case letter each, and ASCII punctuation without the apostrophe.
_LETTERS, _MARKS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+", r"[!-&(-/:-@\[-`{-~]+"


def tokenizer(name: str):
    """A public tokenizer by the name of its file, or by its path."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    if os.path.sep not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Tokenizer.from_file(name)


def cutting(settings: dict) -> str:
    """Where a tokenizer with these settings can be given pieces of a text.

    ``words``: it takes stretches without white space only and drops the rest, so words stand alone.
    ``spaces``: byte-level tokens never run from a character into white space behind it, so
    a text may be cut before each such space. ``none``: anything else gets whole texts.
    """
    import regex

    first = settings.get("pre_tokenizer") or {}
    if first.get("type") == "Sequence":
        first = (first.get("pretokenizers") or [{}])[0]
    if first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space") and not settings.get("normalizer"):
        return "spaces"
    pattern = (first.get("pattern") or {}).get("Regex")
    if first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and pattern:
        probes = ("a b", " 1 2", "! ?", "\t'\n", "'s t", "a b", "  ")
        if not any(re.search(r"\s", m.group()) for p in probes for m in regex.finditer(pattern, p)):
            return "words"
    return "none"


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or the next free one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of texts by the tokenizer of a file, as the tokenizer gives them without special tokens added."""

    def __init__(self, name: str) -> None:
        self.model = tokenizer(name)
        settings = json.loads(self.model.to_str())
        self.cutting = cutting(settings)
        # a piece that holds part of a special token's text must not be parted from the rest of it
        self.special = [t["content"] for t in settings.get("added_tokens") or [] if re.search(r"\s", t["content"])]
        if self.special:
            self.cutting = "none"
        self.known = self._is_known(settings)
        self.plain = re.compile(f" ?{_LETTERS}| ?{_MARKS}").fullmatch
        self.added = [t["content"] for t in settings.get("added_tokens") or []]
        self.letters, self.lower = byte_letters(), self.cutting == "words"
        self.dtype = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        self.letter = "H" if self.dtype.itemsize == 2 else "I"
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _is_known(self, settings: dict) -> bool:
        """Whether the settings are one of the two kinds that are known in full."""
        first, model = settings.get("pre_tokenizer") or {}, settings.get("model") or {}
        if model.get("type") != "BPE" or model.get("dropout"):
            return False
        if self.cutting == "spaces":
            return first == _BYTE_LEVEL
        made = first.get("pretokenizers") or [{}]
        return (
            self.cutting == "words"
            and settings.get("normalizer") == _LOWER_WORDS["normalizer"]
            and made[0].get("pattern") == {"Regex": _LOWER_WORDS["pattern"]}
            and made[1:] == [_BYTE_LEVEL | {"use_regex": False}]
        )

    @classmethod
    def of_worker(cls, name: str) -> "Encoder":
        """The one that this Python worker keeps for a tokenizer."""
        kept = remembered(f"encoding {name}")
        if "encoder" not in kept:
            kept["encoder"] = cls(name)
        return kept["encoder"]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts behind each other, and how many each has; a null text has none."""
        ids, counts, lo = [np.empty(0, self.dtype)], [np.empty(0, np.int64)], 0
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + TOGETHER, side="right")))
            some, n = self._together(texts.slice(lo, hi - lo))
            ids.append(some)
            counts.append(n)
            lo = hi
        return np.concatenate(ids), np.concatenate(counts)

    def _together(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces, bounds = self._pieces(texts)
        found = pieces.dictionary_encode()
        own = self._look_up(found.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(own), self.dtype)
        lengths = np.fromiter((len(x) for x in own), np.int64, len(own)) // self.dtype.itemsize
        starts = np.cumsum(lengths) - lengths
        codes = found.indices.to_numpy()
        sizes = lengths[codes]
        ends = np.append(0, np.cumsum(sizes))
        where = np.repeat(starts[codes] - ends[:-1], sizes)
        where += np.arange(ends[-1])
        return pool[where], np.diff(ends[bounds])

    def _pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts, and the bounds of those of each text."""
        if self.cutting == "none":
            return texts, np.arange(len(texts) + 1)
        cut = texts
        if self.known:  # a letter and a mark behind or before it are never one token
            sign = " " if self.cutting == "words" else _CUT
            cut = pc.replace_substring_regex(cut, f"({_LETTERS[:-1]})({_MARKS[:-1]})", rf"\1{sign}\2")
            cut = pc.replace_substring_regex(cut, f"({_MARKS[:-1]})({_LETTERS[:-1]})", rf"\1{sign}\2")
        if self.cutting == "words":
            lists = pc.ascii_split_whitespace(cut)
        else:
            cut = pc.replace_substring_regex(cut, r"(\S)\n", f"\\1{_CUT}\n")
            lists = pc.split_pattern(pc.replace_substring(cut, " ", f"{_CUT} "), _CUT)
        pieces, bounds = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        return self._mended(texts, pieces, bounds - bounds[0])

    def _mended(self, texts: pa.Array, pieces: pa.Array, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Texts in which a space stands behind white space are cut anew by a pattern; what holds an added token or the sign stays whole."""
        odd = np.zeros(len(texts), bool)
        for sign in [*self.added, _CUT]:
            odd |= pc.match_substring(texts, sign).to_numpy(zero_copy_only=False)
        whole = odd.copy()
        if self.cutting == "spaces":
            blank = pc.or_(pc.utf8_is_space(pc.utf8_slice_codeunits(pieces, -1)), pc.equal(pieces, "")).to_numpy(zero_copy_only=False)
            blank[bounds[1:][np.diff(bounds) > 0] - 1] = False  # the last piece of a text has none behind it
            before = np.append(0, np.cumsum(blank))
            odd |= before[bounds[1:]] > before[bounds[:-1]]
        if not odd.any():
            return pieces, bounds
        sizes, parts, last = np.diff(bounds), [], 0
        for i in np.flatnonzero(odd).tolist():
            text = texts[i].as_py()
            anew = [text] if whole[i] else re.split(r"(?<=\S)(?=[ \n])", text)
            parts += [pieces.slice(bounds[last], bounds[i] - bounds[last]), pa.array(anew, pa.string())]
            sizes[i] = len(anew)
            last = i + 1
        parts.append(pieces.slice(bounds[last]))
        return pa.concat_arrays(parts), np.append(0, np.cumsum(sizes))

    def _look_up(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces as bytes; what has not been met for two generations is forgotten."""
        young, old = self.young, self.old
        out, new, hard = [], [], []
        for p in pieces:
            ids = young.get(p)
            if ids is None:
                ids = old.get(p)
                if ids is not None:
                    self._keep(p, ids)
                elif self.known and self.plain(p):
                    new.append(len(out))
                else:
                    hard.append(len(out))
            out.append(ids)
        gc.disable()  # very many small lists are made and dropped at once
        try:
            # plain pieces are one token before merging, which the model takes as the characters that stand for their bytes
            joined = "\0".join([pieces[i] for i in new])
            joined = (joined.lower() if self.lower else joined).encode().decode("latin-1").translate(self.letters)
            merge = self.model.model.tokenize
            for i, p in zip(new, joined.split(self.letters[0])):
                out[i] = self._keep(pieces[i], array(self.letter, [t.id for t in merge(p)]).tobytes())
            for lo in range(0, len(hard), 5_000):
                some = hard[lo : lo + 5_000]
                for i, e in zip(some, self.model.encode_batch_fast([pieces[i] for i in some], add_special_tokens=False)):
                    out[i] = self._keep(pieces[i], array(self.letter, e.ids).tobytes())
        finally:
            gc.enable()
        if self.held > REMEMBERED:
            self.old, self.young, self.held = young, {}, 0
        return out

    def _keep(self, piece: str, ids: bytes) -> bytes:
        self.young[piece] = ids
        self.held += len(piece) + len(ids) + ENTRY
        return ids


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` behind those of each text, and the counts with it."""
    counts = counts + 1
    out = np.full(len(ids) + len(counts), end, ids.dtype)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(counts) - 1] = False
    out[inside] = ids
    return out, counts


def binary_rows(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The ids of each text as a binary value; the values share one buffer, of at most 2 GB."""
    offsets = np.append(0, np.cumsum(counts * ids.dtype.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))])
