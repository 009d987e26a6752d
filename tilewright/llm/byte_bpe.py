"""Byte-level BPE of whole texts with the tokenizers library, through a cache of pieces.

A text is cut before every single space that stands between two characters that are no white space. The
pre-tokenizer's pattern never matches across such a place, and no special token holds one, so the ids of a text are
the ids of its pieces in a row. Arrow cuts a batch and numbers its distinct pieces; each worker keeps the ids
of words it has met (about ``CACHE``, then the half met first stays, which holds the common ones) and asks the library only for new ones. A space, letters
and a tail of ASCII punctuation make two pre-tokens: the library's model merges the letters alone, and tails are kept
apart; anything else goes through the whole library. A piece that is empty or begins or ends with white space
shows that the text has runs of it; such a text goes to the library in one.
"""

from __future__ import annotations

import os
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tilewright.llm.common import TAIL, letters_of_bytes

#: Words a worker remembers; bounds its memory, not the result.
CACHE = 600_000

_encoders: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """One for each worker process and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = ByteBpe(path)
    return _encoders[path]


class ByteBpe:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.known: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        letters = letters_of_bytes()
        self.spell = [letters[b] for b in range(256)]
        self.wide: dict[int, str] = {}
        self.tails: dict[str, bytes] = {}

    def _ask(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, dtype="<u4").tobytes() for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _spelled(self, word: str) -> str:
        """Letters as the vocabulary writes their bytes."""
        for c in word:
            if ord(c) not in self.wide:
                self.wide[ord(c)] = "".join(self.spell[b] for b in c.encode())
        return word.translate(self.wide)

    def _ids(self, words: list[str], inner: bool) -> list[bytes | None]:
        """Ids of each word, after a space if inner; None where it can't stand alone."""
        known, tails, model, space = self.known[inner], self.tails, self.library.model.tokenize, self.spell[32] if inner else ""
        if len(known) > CACHE:
            for word in list(islice(known, CACHE // 2, None)):
                del known[word]
        out: list[bytes | None] = list(map(known.get, words))
        odd = []
        for i in [i for i, ids in enumerate(out) if ids is None]:
            word = words[i]
            core = word.rstrip(TAIL)
            if core.isalpha():
                ids = known.get(core) if len(core) < len(word) else None
                if ids is None:
                    ids = known[core] = array("I", [t.id for t in model(space + (core if core.isascii() else self._spelled(core)))]).tobytes()
                if len(core) < len(word):
                    tail = word[len(core) :]
                    if tail not in tails:
                        if len(tails) > CACHE:
                            tails.clear()
                        tails[tail] = self._ask([tail])[0]
                    ids += tails[tail]
                out[i] = ids
            elif word and not word[0].isspace() and not word[-1].isspace():
                odd.append(i)
        for i, ids in zip(odd, self._ask([" " + words[i] if inner else words[i] for i in odd])):
            out[i] = known[words[i]] = ids
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A string column (nulls as empty) -> all ids in a row, and the number of each text's."""
        texts = pc.fill_null(texts, "")
        cut = pc.split_pattern(texts, " ")
        offsets = np.asarray(cut.offsets) - cut.offsets[0].as_py()
        coded = pc.dictionary_encode(cut.flatten())
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        words, codes = coded.dictionary.to_pylist(), np.array(coded.indices, dtype=np.int32)
        first = offsets[:-1]
        openings = [words[c] for c in codes[first].tolist()]  # a text's first piece has no space before it
        codes[first] = len(words) + np.arange(len(first), dtype=np.int32)
        ids = self._ids(words, True) + self._ids(openings, False)
        whole = np.array([x is None for x in ids], dtype=bool)
        packed = pa.array([x or b"" for x in ids], pa.binary()).take(pa.array(codes))
        run = np.frombuffer(packed.buffers()[1], np.int32, len(codes) + 1, 4 * packed.offset) // 4
        flat = np.frombuffer(packed.buffers()[2] or b"", "<u4", int(run[-1]))
        counts = (run[offsets[1:]] - run[offsets[:-1]]).astype(np.int64)
        bad = np.flatnonzero(np.add.reduceat(whole[codes], first)) if len(first) and whole.any() else []
        if len(bad):
            parts, last = [], 0
            for i in bad.tolist():
                own = np.frombuffer(self._ask([texts[i].as_py()])[0], "<u4")
                parts += [flat[last : run[offsets[i]]], own]
                last, counts[i] = run[offsets[i + 1]], len(own)
            flat = np.concatenate([*parts, flat[last:]])
        return flat, counts
