"""The words that a word-level BPE tokenizer file cuts a text into, before its merges.

The file (normaliser: canonical composition, white space to spaces, lower case; then contractions,
runs of letters, single digits and runs of other signs) is read by the tokenizers library. Texts of
characters below U+0250 are cut by an equal pattern of Python's; all others by the library's own
normaliser and splitter."""

from __future__ import annotations

import re
import sys
import unicodedata

from .common import kept

_RANGE = [chr(c) for c in range(0x250)]
_LETTER = "".join(re.escape(c) for c in _RANGE if unicodedata.category(c)[0] == "L")
_NUMBER = "".join(re.escape(c) for c in _RANGE if unicodedata.category(c)[0] == "N")
_BLANK = "\t-\r \x85\xa0"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+")
_FAR = re.compile("[^\x00-ɏ]")
SPECIAL = re.compile(r"(<\|startoftext\|>|<\|endoftext\|>)")


@kept
def tokenizer(path: str):
    """The library's tokenizer, one for each worker, without threads of its own."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


@kept
def word_tokenizer(path: str):
    """The same without its normaliser, for words that are normalised already: to do it twice is not always the same."""
    from tokenizers import normalizers

    tok = type(tokenizer(path)).from_str(tokenizer(path).to_str())
    tok.normalizer = normalizers.Sequence([])
    return tok


def words_of(text: str, path: str) -> list[str]:
    """The words of a text in order, special tokens among them as they stand."""
    if "<|" in text:
        parts = SPECIAL.split(text)
        return [w for p in parts for w in ([p] if SPECIAL.fullmatch(p) else _plain(p, path))]
    return _plain(text, path)


def _plain(text: str, path: str) -> list[str]:
    low = text.lower()
    try:
        text.encode("latin-1")  # a quick look first
        return _WORDS.findall(low)
    except UnicodeEncodeError:
        if not _FAR.search(text) and not _FAR.search(low):  # a lower-case letter may lie farther than its capital
            return _WORDS.findall(low)
    tok = tokenizer(path)
    text = tok.normalizer.normalize_str(text)
    return [text[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(text)]


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary strings: printable Latin-1 for itself, the others
    in order from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, sys.maxunicode))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]
