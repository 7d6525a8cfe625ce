"""Splitting texts into the words that a BPE model encodes alone.

A BPE tokenizer first cuts a text into pieces by a pattern and then merges
within each piece, so the ids of a text are the concatenated ids of its words,
as long as no piece spans two words, and each distinct word needs encoding
only once. ``WordTokenizer`` reads a tokenizer's JSON and does both steps
exactly as the tokenizers library does:

* Texts of ASCII and Latin-1 letters are cut at white space, where no pattern
  of the two known kinds lets a piece run on. Any other text goes through the
  library's own normalizer and pre-tokenizer.
* Special tokens of the JSON are found in the raw text, before anything else,
  and form words of their own, as in the library's ``encode``.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Sequence
from functools import cached_property

# One task per core: the library must not start threads of its own.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_OTHER_CHARS = re.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ]")
_SPACE_PAIRS = ["  ", *(p for c in "\t\n\v\f\r" for p in (" " + c, c + " "))]
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")

# Fixed value: the split pattern of the word BPE's JSON.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same pattern for words of lower-case ASCII and Latin-1 letters.
_LATIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+"
_WORD_PIECES = re.compile(_LATIN_PATTERN)
_PIECES_OR_END = re.compile(_LATIN_PATTERN + r"|\n")

_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")


def _is_latin(text: str) -> bool:
    """Only characters that Python and the library class and lower alike."""
    return not (_CONTROL if text.isascii() else _OTHER_CHARS).search(text)


#: Marks a special token's word; no ordinary word has two line ends before it.
_SPECIAL = "\n\n"

_loaded: dict[str, "WordTokenizer"] = {}


class WordTokenizer:
    """``split(text)`` gives a text's words, ``encode(words)`` their ids."""

    def __init__(self, spec: str):
        conf = json.loads(spec)
        for t in conf["added_tokens"]:
            if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError(f"added token {t['content']!r} is not a plain special token")
        if conf["model"]["type"] != "BPE":
            raise ValueError("a BPE model is needed")
        self.digest = hashlib.sha256(spec.encode()).hexdigest()
        self._special_ids = {t["content"]: t["id"] for t in conf["added_tokens"]}
        specials = sorted(self._special_ids, key=len, reverse=True)
        self._special_pattern = re.compile(
            "(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self._kind = self._known_kind(conf)
        self._spec = spec

    # The library's objects take tens of MB each, so a worker makes only those
    # that its task uses.

    @cached_property
    def _whole(self):
        """Of whole texts only the normalizer and the pre-tokenizer, so no vocabulary."""
        from tokenizers import Tokenizer
        conf = json.loads(self._spec)
        model = conf["model"] | {"vocab": {}, "merges": [], "unk_token": None}
        return Tokenizer.from_str(json.dumps(conf | {"model": model, "added_tokens": [], "post_processor": None}))

    @cached_property
    def _one(self):
        """Over a normalized word."""
        from tokenizers import Tokenizer, normalizers
        one = Tokenizer.from_str(self._spec)
        one.normalizer = normalizers.Sequence([])
        one.encode_special_tokens = True
        return one

    def drop_encoder(self) -> None:
        """Let go of the encoder, which the words' encoding has left in a worker
        whose next tasks only split."""
        self.__dict__.pop("_one", None)

    def id_to_piece(self) -> dict[int, str]:
        vocab = json.loads(self._spec)["model"]["vocab"]
        return {i: p for p, i in (vocab | self._special_ids).items()}

    @staticmethod
    def _known_kind(conf: dict) -> str:
        """``byte`` or ``word`` when white space is known to end every piece;
        else ``other``, whose texts all take the library's pre-tokenizer."""
        norm, pre = conf["normalizer"], conf["pre_tokenizer"]
        if norm is None and pre["type"] == "ByteLevel" and pre["use_regex"] \
                and not pre["add_prefix_space"]:
            return "byte"
        steps = [n["type"] for n in (norm or {}).get("normalizers", [])]
        parts = (pre or {}).get("pretokenizers", [])
        if steps == ["NFC", "Replace", "Lowercase"] and len(parts) == 2 \
                and norm["normalizers"][1]["pattern"].get("Regex") == r"\s+" \
                and norm["normalizers"][1]["content"] == " " \
                and parts[0].get("pattern", {}).get("Regex") == _WORD_PATTERN \
                and parts[0]["invert"] and parts[0]["behavior"] == "Removed" \
                and not parts[1]["use_regex"] and not parts[1]["add_prefix_space"]:
            return "word"
        return "other"

    @staticmethod
    def load(spec: str) -> "WordTokenizer":
        """One instance per worker process and tokenizer."""
        key = hashlib.sha256(spec.encode()).hexdigest()
        if key not in _loaded:
            _loaded[key] = WordTokenizer(spec)
        return _loaded[key]

    def split(self, text: str | None) -> list[str]:
        if not text:
            return []
        if any(t in text for t in self._special_ids):
            out: list[str] = []
            for part in self._special_pattern.split(text):
                out.extend([_SPECIAL + part] if part in self._special_ids else self._split(part))
            return out
        return self._split(text)

    def lowered(self, text: str) -> str | None:
        """The text whose white-space runs alone part its words, where that is
        all there is to ``split``; else None."""
        if self._kind != "word" or any(t in text for t in self._special_ids) or not _is_latin(text):
            return None
        return text.lower()

    def _split(self, text: str) -> list[str]:
        if not text:
            return []
        latin = _is_latin(text)
        if self._kind == "word":
            if latin:
                return text.lower().split()
            # the normalizer has turned every white space run into one space
            return [w for w in self._whole.normalizer.normalize_str(text).split(" ") if w]
        if self._kind == "byte" and latin:
            if text[0] == " " or text[-1] == " " or any(p in text for p in _SPACE_PAIRS):
                first, *rest = _SINGLE_SPACE.split(text)
            else:
                first, *rest = text.split(" ")
            return [first, *[" " + w for w in rest]]
        if self._whole.normalizer is not None:
            text = self._whole.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self._whole.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, word: str) -> list[str]:
        """The pieces of a word that the model encodes alone, as texts."""
        if word.startswith(_SPECIAL) or self._kind == "other":
            return [word]
        if self._kind == "word" and _is_latin(word):
            return _WORD_PIECES.findall(word)
        return [word[a:b] for _, (a, b) in self._whole.pre_tokenizer.pre_tokenize_str(word)]

    def pieces_of_lines(self, lines: str) -> list[str]:
        """Pieces of words that ``lowered`` texts have, one word to a line,
        with the line ends between them."""
        return _PIECES_OR_END.findall(lines)

    def encode(self, words: Sequence[str]) -> list[list[int]]:
        """Ids of each word (or piece); give each distinct one once."""
        out = [e.ids for e in self._one.encode_batch_fast(list(words), add_special_tokens=False)]
        for i, w in enumerate(words):
            if w.startswith(_SPECIAL) and w[len(_SPECIAL):] in self._special_ids:
                out[i] = [self._special_ids[w[len(_SPECIAL):]]]
        return out


def read_spec(path: str) -> str:
    """The tokenizer's JSON, read where the driver runs and shipped from there
    (under 2 MB: a fixed vocabulary, whatever the size of the corpus)."""
    with open(path, encoding="utf-8") as f:
        return f.read()
