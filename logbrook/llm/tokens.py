"""Token ids of whole texts, by the tokenizers library, a distinct word at a time.

The vocabulary's rules never look across white space, so a text's ids are those
of its words in a row. Words repeat, so each distinct one of a piece of texts is
encoded once and its ids are copied to wherever it stands; that gives the ids of
the library over the whole text, at many times its speed. Words of Latin letters,
perhaps with stops behind, go straight to the library's merges in the form its
own normaliser and splitter give them; all others go through the whole library.
"""

from __future__ import annotations

import os
import re
import string

import numpy as np
import pyarrow as pa

from logbrook.llm.batches import Words

MOST_WORDS = 1 << 18
"""How many words are remembered; the memory starts anew beyond."""

# Marks that the splitter takes as one run when they end a word; an apostrophe may begin a part of its own.
STOPS = string.punctuation.replace("'", "")
# Letters that the normaliser only lower-cases, each to one letter.
PLAIN = re.compile("[a-zà-öø-ÿ]+")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes texts by a vocabulary file whose words end at white space."""

    def __init__(self, path: str) -> None:
        self.path = path
        self._ready = False

    def __getstate__(self) -> dict:
        return {"path": self.path, "_ready": False}

    def _load(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._whole = Tokenizer.from_file(self.path)
        self._whole.no_truncation()
        # The written form of each byte: the library's own, asked for byte by byte.
        split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = "".join(map(chr, range(0x80, 0x100)))
        shown = split.pre_tokenize_str(letters)[0][0]
        octets = letters.encode()
        self._shown = {octet: ord(mark) for octet, mark in zip(octets, shown)}
        self._merge = self._whole.model.tokenize
        self._stems: dict[str, tuple[int, ...]] = {}
        self._tails: dict[str, tuple[int, ...]] = {"": ()}
        self._words: dict[str, tuple[int, ...]] = {}
        self._ready = True

    def size(self) -> int:
        """How many ids the vocabulary has."""
        if not self._ready:
            self._load()
        return self._whole.get_vocab_size()

    def _word(self, word: str) -> tuple[int, ...]:
        stem = word.rstrip(STOPS)
        low = stem.lower()
        ids = self._stems.get(low)
        if ids is None:
            if not PLAIN.fullmatch(low):
                return tuple(self._whole.encode(word, add_special_tokens=False).ids)
            form = low if low.isascii() else low.encode().decode("latin-1").translate(self._shown)
            ids = self._stems[low] = tuple([token.id for token in self._merge(form)])
        if len(stem) == len(word):
            return ids
        tail = word[len(stem) :]
        if tail not in self._tails:
            self._tails[tail] = tuple(self._whole.encode(tail, add_special_tokens=False).ids)
        return ids + self._tails[tail]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text ends in them. A null text has none."""
        if not self._ready:
            self._load()
        if len(self._words) > MOST_WORDS:
            self._words, self._stems, self._tails = {}, {}, {"": ()}
        words = Words(texts)
        distinct = words.distinct.to_numpy(zero_copy_only=False).tolist()
        known = self._words
        found = list(map(known.get, distinct))
        for at, ids in enumerate(found):
            if ids is None:
                word = distinct[at]
                found[at] = known[word] = self._word(word)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        own = sizes[words.code]
        ends = np.cumsum(own)
        places = np.repeat(starts[words.code] - (ends - own), own) + np.arange(ends[-1] if len(ends) else 0)
        per_text = np.zeros(len(texts), np.int64)
        np.add.at(per_text, words.text, own)
        return flat[places], np.cumsum(per_text)
