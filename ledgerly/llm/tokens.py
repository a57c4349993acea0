"""Whole-text encoding with the tokenizers library, one model call per distinct word.

A byte-pair model never merges across the words its pre-tokenizer cuts.  So a
text is cut where the pre-tokenizer cuts for certain, each distinct piece is
resolved once per worker process, and texts are assembled from the pieces' ids
with numpy.  Plain pieces (no character above U+017F) are split by the
vocabulary's own published pattern and their words go to the library's model;
any other piece goes through the library's full tokenizer, and so does a whole text
that holds one of the vocabulary's added tokens (they get their own ids, as in a plain
call of the library).  The result equals encoding the text in one call
(tests/llm/test_tokens.py holds it to that); an encoder that doesn't pass that test on a
few texts, as the file's patterns are others, is refused.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np

from .common import remembered

#: Distinct words remembered in one worker process; beyond it memory starts anew.
MAX_WORDS = 400_000

_WORD_END = "</w>"
#: Before a piece that goes through the full tokenizer; no plain text holds it.
_FULL = "\x00"
#: Letters and digits up to U+017F, and with them the published
#: pre-tokenization patterns of the two public vocabularies.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾"
_PLAIN = re.compile(r"[\x20-\x7e\n\xa1-\xac\xae-ſ]*")
_PATTERN_BYTES = re.compile(rf" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
#: Texts on which an encoder must agree with the library.
_PROBES = ["It's a test, isn't it? 12345 abc123!!", " two  blanks\nand\n\nlines ", "Grüße à l'été, año ½ “x” 日本 語 ß", "UPPER lower don't 3rd...", "<|x|> [y] <z>"]
_PATTERN_WORDS = re.compile(rf"[{_L}]+|'(?:[stmd]|re|ve|ll)|[{_N}]|[^\s{_L}{_N}]+")


def tokenizer_path(name: str) -> str:
    """Where an installed public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def library_tokenizer(path: str):
    """The tokenizer of a file, loaded once per process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(other)}


class _Numbers(dict):
    """Gives each new key the next number and remembers it as new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


class _Ragged:
    """Growing lists of ids, addressed by number."""

    def __init__(self):
        self.flat = np.zeros(1 << 16, np.int32)
        self.first = np.zeros(1 << 14, np.int64)
        self.size = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        end = int(self.first[self.size])
        if end + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat[:end], np.zeros(end + 2 * len(ids), np.int32)])
        if self.size + len(sizes) + 1 > len(self.first):
            self.first = np.concatenate([self.first[: self.size + 1], np.zeros(self.size + 2 * len(sizes), np.int64)])
        self.flat[end : end + len(ids)] = ids
        self.first[self.size + 1 : self.size + 1 + len(sizes)] = end + np.cumsum(sizes)
        self.size += len(sizes)

    def gather(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo = self.first[k]
        n = self.first[k + 1] - lo
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(lo - ends + n, n)], n


class WordEncoder:
    """Encodes batches of whole texts with one public vocabulary file.

    ``blanks`` says whether white space counts: byte-level vocabularies give a
    word the blank before it; the others drop white space and letter case.
    """

    def __init__(self, path: str, blanks: bool):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = library_tokenizer(path)
        self.blanks = blanks
        self.split = (_PATTERN_BYTES if blanks else _PATTERN_WORDS).findall
        self.bare = Tokenizer(self.tok.model)
        self.bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        vocab = self.tok.get_vocab(with_added_tokens=False)
        size = max(vocab.values()) + 1
        self.letters, self.ends = np.zeros(size, np.int64), np.zeros(size, bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith(_WORD_END)
            self.letters[i] = len(token)
        added = sorted({t.content.lower() for t in self.tok.get_added_tokens_decoder().values()})
        self.added = re.compile("|".join(map(re.escape, added))).search if added else None
        self._clear()
        want = [e.ids for e in self.tok.encode_batch(_PROBES, add_special_tokens=False)]
        ids, n = self.encode(_PROBES)
        if [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] != want:
            raise ValueError(f"{path} cuts words by other patterns than this encoder knows")

    def _clear(self) -> None:
        self.words, self.ids = _Numbers(), _Ragged()

    def _learn(self) -> None:
        """Runs the library over the words met for the first time, in the order of their numbers."""
        table, new = _byte_letters(), self.words.new
        for at in range(0, len(new), 4000):
            some = new[at : at + 4000]
            plain = [w for w in some if w[0] != _FULL]
            shown = [w if w.isascii() and w.isalnum() else w.encode().decode("latin-1").translate(table) for w in plain]
            ids = np.array(self.bare.encode_batch_fast(["\n".join(shown)], add_special_tokens=False)[0].ids if shown else [], np.int32)
            if self.blanks:  # tokens spell the word exactly
                last = np.searchsorted(np.cumsum(self.letters[ids]), np.cumsum([len(x) for x in shown]))
            else:
                last = np.flatnonzero(self.ends[ids])
            sizes = np.diff(last, prepend=-1)
            if len(plain) < len(some):
                full = iter(self.tok.encode_batch_fast([w[1:] for w in some if w[0] == _FULL], add_special_tokens=False))
                known = iter(np.split(ids, np.cumsum(sizes)[:-1]))
                parts = [np.array(next(full).ids, np.int32) if w[0] == _FULL else next(known) for w in some]
                ids, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
            self.ids.add(ids, sizes)
        new.clear()

    def _pieces(self, text: str) -> list[str]:
        """Cuts a text so that no piece's ids depend on what stands around it."""
        if not self.blanks:
            return text.replace("\n", " ").split(" ")
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n" or not text.replace("\n", "").isprintable():
            return [text]  # rare: white space that a cut could tear apart
        head, *rest = text.replace("\n", " \n").split(" ")
        return [head, *[x if x[0] == "\n" else " " + x for x in rest]]

    def _words(self, text: str) -> list[str]:
        if self.added and self.added(text.lower()):
            return [_FULL + text]
        if text.isascii() and text.replace("\n", "").isprintable() or _PLAIN.fullmatch(text):
            return self.split(text if self.blanks else text.lower())
        out: list[str] = []
        for p in self._pieces(text):
            if not _PLAIN.fullmatch(p):
                out.append(_FULL + p)
            else:
                out += self.split(p if self.blanks else p.lower())
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text; null counts as empty."""
        if len(self.words) > MAX_WORDS:
            self._clear()
        number, found, counts = self.words.__getitem__, [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                words = self._words(t)
                found.append(np.fromiter(map(number, words), np.int64, len(words)))
                counts[i] = len(words)
        self._learn()
        ids, n = self.ids.gather(np.concatenate(found) if found else np.zeros(0, np.int64))
        before = np.concatenate([[0], np.cumsum(n)])
        end = np.cumsum(counts)
        return ids, before[end] - before[end - counts]


def encoder(path: str, blanks: bool) -> WordEncoder:
    """One encoder per worker process: tasks that follow find its words known."""
    return remembered(WordEncoder, path, blanks)
