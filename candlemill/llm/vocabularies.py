"""Token ids of words, by vocabularies of public tokenizers, remembered from word to word.

The two vocabularies drop or mark white space, so the ids of a text are those of its words one
after the other, and a word needs to be encoded once per worker. Files are named by a path, which
every worker opens; nothing of them is copied. What is remembered is bounded by ``REMEMBER``.
"""

from __future__ import annotations

import os
import re
import string
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa

from candlemill.llm.text import Words, byte_table, pieces, words

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
# Words that each of a worker's two generations remembers, some 150 bytes a word.
REMEMBER = 150_000
# Bytes of text whose distinct words are looked up together.
PIECE_BYTES = 2_000_000

# Letters that Python and the vocabulary lower-case alike, one to one.
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
# A letter before one of these symbols ends a unit of the pattern; ``'`` may begin endings like 's.
_LETTERS = byte_table(string.ascii_letters)
_SYMBOLS = byte_table(".,;:!?#$%&*")
_loaded: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of words as bytes of 16-bit numbers. Subclasses encode lists of new words.

    Distinct words of a piece of texts are looked up by their 64-bit hashes. They are remembered in
    two generations: a full one becomes the old one, from which words that still occur are taken
    over, so frequent words stay.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        self.young: dict[int, bytes] = {}
        self.old: dict[int, bytes] = {}

    def encode_new(self, words: list[str]) -> list[bytes]:
        raise NotImplementedError

    def split(self, piece: pa.Array) -> Words:
        """Parts of texts whose ids do not depend on each other."""
        return words(piece, lower=False)

    def _lookup(self, w: Words, hashes: np.ndarray, at: np.ndarray) -> list[bytes]:
        """Ids of distinct words, given by their hashes and one place of each."""
        if len(self.young) > REMEMBER:
            self.young, self.old = {}, self.young
        keys, young, old = hashes.tolist(), self.young, self.old
        ids = [young.get(k) for k in keys]
        missing = [i for i, x in enumerate(ids) if x is None]
        new = []
        for i in missing:
            found = old.get(keys[i])
            if found is None:
                new.append(i)
            else:
                ids[i] = young[keys[i]] = found
        raw, start, end = w.data.tobytes(), w.start[at].tolist(), w.end[at].tolist()
        for i, found in zip(new, self.encode_new([raw[start[i] : end[i]].decode() for i in new])):
            ids[i] = young[keys[i]] = found
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts one after the other, and the first id of each text (one more)."""
        parts, first = [], [np.zeros(1, np.int64)]
        for _, piece in pieces(texts, PIECE_BYTES):
            w = self.split(piece)
            distinct, at, inverse = np.unique(w.hashes(), return_index=True, return_inverse=True)
            ids = self._lookup(w, distinct, at)
            flat = np.frombuffer(b"".join(ids), np.uint16)
            size = np.array([len(x) for x in ids], np.int64) // 2
            begin = np.cumsum(size) - size
            times = size[inverse]
            ends = np.cumsum(times)
            place = np.repeat(begin[inverse] - (ends - times), times) + np.arange(times.sum())
            parts.append(flat[place])
            first.append(np.append(0, ends)[w.first[1:]] + first[-1][-1])
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint16)), np.concatenate(first)


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: themselves, or from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordBpe(WordEncoder):
    """Byte pairs with word ends; equal to encoding the whole text with the tokenizers library.

    That vocabulary ignores case, and its pattern cuts runs of letters from runs of symbols. So a
    word's trailing punctuation is encoded apart, and a run of plain letters, which is one unit to
    the pattern, goes to the library's byte-pair model at once. All else goes through the whole
    tokenizer.
    """

    def __init__(self, path: str) -> None:
        super().__init__(path)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()

    def split(self, piece: pa.Array) -> Words:
        # Special tokens hold symbols, and are such in lower case alone.
        w = words(piece, cut=(_LETTERS, _SYMBOLS))
        return words(piece, lower=False) if b"<|" in w.data.tobytes() else w

    def _encode(self, unit: str) -> bytes:
        if _PLAIN.fullmatch(unit):
            written = unit if unit.isascii() else "".join([self.letters[b] for b in unit.encode()])
            ids = [t.id for t in self.model.tokenize(written)]
        else:
            ids = self.tokenizer.encode(unit, add_special_tokens=False).ids
        return array("H", ids).tobytes()

    def encode_new(self, words: list[str]) -> list[bytes]:
        out, units = [], {"": b""}
        for w in words:
            core = w.rstrip(string.punctuation)
            # Special tokens are written in punctuation; a mark may join the symbol before it.
            if not core or "<|" in w or not core[-1].isalnum():
                core = w
            tail = w[len(core) :]
            if _PLAIN.fullmatch(core):
                core = core.lower()
            for unit in (core, tail):
                if unit not in units:
                    units[unit] = self._encode(unit)
            out.append(units[core] + units[tail])
        return out


class PieceBpe(WordEncoder):
    """Pieces with byte fallback: each word is encoded with the mark of a space before it."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])

    def encode_new(self, words: list[str]) -> list[bytes]:
        return [array("H", ids).tobytes() for ids in self.model.encode(words, num_threads=1)]


def encoder(name: str = WORD_BPE) -> WordEncoder:
    """This worker's encoder for a vocabulary file: a path, or a name below public_tokenizers."""
    if name not in _loaded:
        path = name if os.path.isabs(name) else public_tokenizers.path(name)
        _loaded[name] = PieceBpe(path) if re.search(r"\.model$", path) else WordBpe(path)
    return _loaded[name]
