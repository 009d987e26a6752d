"""BPE with word ends, through a minimal acyclic transducer of frequent words.

Words are what the pre-tokenizer makes of the normalised text; each is merged alone. The most frequent words of all
documents are compiled, with the ids of each, into an acyclic automaton that shares prefixes and suffixes. Its
arcs carry numbers that add up to a word's place in the lexicon, and a table gives the ids of each place. The
automaton is one flat file: Spark ships it to every executor, whose workers map it into memory together. Words
are looked up in it all at once, a byte of each a step. Words that it lacks are merged exactly, also all at once: the pair of
lowest rank in each, leftmost first, until none is left.

Texts are cut at ASCII white space, which no word and no special token crosses, and Arrow numbers a batch's distinct
pieces; each worker remembers the ids of words it has met (about ``CACHE``, then the half met first stays). Decoding looks each id's string up and joins them by a
space, as the library does for a vocabulary without a decoder.

Defined results: null is the empty text, which has no ids and decodes to nothing; special tokens in a text become their
ids; texts and words of any length are encoded whole; empty tables, ties and repeated rows need nothing special; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import struct
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import TAIL, groups, letters_of_bytes, ship, spans
from tilewright.session import materialize

#: Words compiled into the automaton: bounds the file (some MB), not the result.
LEXICON = 65_536
#: Words a worker remembers, and distinct words it counts before it hands them on.
CACHE = 150_000
#: Bytes of text a worker takes at once: its pieces, ids and decoded strings are some ten times as large.
PIECE = 4 << 20
#: Longer words are left to the merging code.
LONGEST = 40
HEAD = struct.Struct("<4sIII")
NONE = np.int32(1 << 30)


# ---------------------------------------------------------------- automaton


def build_automaton(words: list[bytes], ids: list[list[int]]) -> bytes:
    """The minimal automaton of sorted, distinct words, with the ids of each, as one flat file.

    States are registered from the leaves up by (final, arcs), so equal right parts become one state.
    """
    registry: dict[tuple, int] = {}
    arcs: list[tuple[tuple[int, int], ...]] = []
    finals: list[bool] = []

    def freeze(final: bool, out: list[tuple[int, int]]) -> int:
        key = (final, *out)
        if key not in registry:
            registry[key] = len(arcs)
            arcs.append(tuple(out))
            finals.append(final)
        return registry[key]

    path: list[list] = [[False, []]]  # open states along the last word: final, arcs
    last = b""
    for word in [*words, None]:
        keep = 0 if word is None else len(os.path.commonprefix((last, word)))
        while len(path) > keep + 1:
            final, out = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(final, out)))
        if word is None:
            break
        path += [[False, []] for _ in word[keep:]]
        path[-1][0] = True
        last = word
    root = freeze(*path[0])
    below = [0] * len(arcs)
    keys, targets, outputs = [], [], []
    for state, out in enumerate(arcs):  # targets come before the states that point to them
        n = int(finals[state])
        for byte, target in out:
            keys.append(state << 8 | byte)
            targets.append(target)
            outputs.append(n)
            n += below[target]
        below[state] = n
    lengths = np.array([len(x) for x in ids], dtype=np.int64)
    flat = np.array([i for x in ids for i in x], dtype="<u4")
    return b"".join((
        HEAD.pack(b"TWA1", len(arcs), len(keys), len(words)), struct.pack("<Q", root), np.concatenate(([0], np.cumsum(lengths))).astype("<u4").tobytes(),
        np.array(keys, dtype="<u4").tobytes(), np.array(targets, dtype="<u4").tobytes(), np.array(outputs, dtype="<u4").tobytes(), flat.tobytes(), np.array(finals, dtype=np.uint8).tobytes(),
    ))


class Automaton:
    """A mapped file of build_automaton."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        _, self.states, n, words = HEAD.unpack(raw[: HEAD.size].tobytes())
        self.root = struct.unpack("<Q", raw[HEAD.size : HEAD.size + 8].tobytes())[0]
        at = HEAD.size + 8

        def take(count: int) -> np.ndarray:
            nonlocal at
            out = raw[at : at + 4 * count].view("<u4")
            at += 4 * count
            return out

        self.at, self.keys, self.targets, self.outputs = take(words + 1), take(n), take(n), take(n)
        self.ids = take(int(self.at[-1]) if words else 0)
        self.finals = raw[at:]

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the lexicon, -1 where it has none."""
        out = np.full(len(words), -1, dtype=np.int64)
        if not len(self.keys) or not words:
            return out
        sizes = np.array([len(w) for w in words])
        octets = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(sizes) - sizes
        rows = np.flatnonzero((sizes > 0) & (sizes <= LONGEST))
        rows = rows[np.argsort(-sizes[rows], kind="stable")]
        state, place = np.full(len(rows), self.root, dtype=np.uint32), np.zeros(len(rows), dtype=np.int64)
        step = 0
        while len(rows):
            key = state << np.uint32(8) | octets[first[rows] + step]
            arc = np.searchsorted(self.keys, key)
            arc[arc == len(self.keys)] = 0
            there = self.keys[arc] == key
            rows, arc = rows[there], arc[there]
            state, place = self.targets[arc], place[there] + self.outputs[arc]
            step += 1
            ended = sizes[rows] == step
            done = ended & (self.finals[state] == 1)
            out[rows[done]] = place[done]
            rows, state, place = rows[~ended], state[~ended], place[~ended]
        return out

    def ids_of(self, place: int) -> np.ndarray:
        return self.ids[self.at[place] : self.at[place + 1]]


# ---------------------------------------------------------------- vocabulary


class WordBpe:
    """Normaliser, pre-tokenizer and merges of a vocabulary file with word ends."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.library = Tokenizer.from_file(path)  # for the normalisation of rare scripts
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.strings = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items() | self.special.items():
            self.strings[i] = token.encode()
        letters = letters_of_bytes()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int32)
        self.final = np.array([vocab[c + self.suffix] for c in letters], dtype=np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        self.rank_of = dict(zip(keys.tolist(), range(len(pairs))))

    def words(self, piece: bytes) -> list[bytes | int]:
        """A piece without ASCII white space -> its words in UTF-8, special tokens as their ids."""
        text = piece.decode("utf-8", "replace")
        if "<|" in text and self.cut_special and self.cut_special.search(text):
            out: list[bytes | int] = []
            for part in self.cut_special.split(text):
                if part in self.special:
                    out.append(self.special[part])
                elif part:
                    out += self._plain(part)
            return out
        return self._plain(text)

    @staticmethod
    def core_and_tail(piece: str) -> tuple[str, str] | None:
        """A piece of Latin letters and then ASCII punctuation, either or both, is these two words; else None."""
        core = piece.rstrip(TAIL)
        if core and not (core.isalpha() and (core.isascii() or max(core) <= "ɏ")):
            return None
        low = core.lower()
        return (low, piece[len(core) :]) if len(low) == len(core) else None

    def _plain(self, text: str) -> list[bytes]:
        if text.isascii() and text.isprintable() or all(" " < c <= "~" or "\xa1" <= c <= "ɏ" for c in text):
            return [w.encode() for w in self.pattern.findall(unicodedata.normalize("NFC", text).lower())]
        back = _letter_bytes()
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(back[c] for c in w) for w, _ in cut]

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each non-empty word."""
        out: list[np.ndarray | None] = [None] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            n = len(word)
            if n > LONGEST:
                out[i] = self._merge_long(word)
            else:
                by_size.setdefault(max(4, 1 << (n - 1).bit_length()), []).append(i)
        for width, rows in by_size.items():
            for at in range(0, len(rows), 65_536):
                some = rows[at : at + 65_536]
                for i, ids in zip(some, self._merge_many([words[i] for i in some], width)):
                    out[i] = ids
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def _merge_many(self, words: list[bytes], width: int) -> list[np.ndarray]:
        n = len(words)
        sizes = np.array([len(w) for w in words])
        ids = np.full((n, width + 1), -1, dtype=np.int32)
        octets = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(n), sizes)
        ids[row, np.arange(len(octets)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = self.inner[octets]
        ids[np.arange(n), sizes - 1] = self.final[octets[np.cumsum(sizes) - 1]]
        rank = np.full((n, width + 1), NONE, dtype=np.int32)
        rank[:, :width] = self._rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width)
        step, live = np.arange(width + 1), np.arange(n)
        while len(live):
            part = rank[live]
            at = part.argmin(axis=1)
            low = part[np.arange(len(live)), at]
            live, at, low = live[low < NONE], at[low < NONE], low[low < NONE]
            if not len(live):
                break
            shift = np.minimum(step + (step > at[:, None]), width)
            new = np.take_along_axis(ids[live], shift, axis=1)
            new[:, width] = -1
            new[np.arange(len(live)), at] = self.made[low]
            part = np.take_along_axis(rank[live], shift, axis=1)
            part[:, width] = NONE
            here = np.arange(len(live))
            part[here, at] = self._rank(new[here, at], new[here, np.minimum(at + 1, width)])
            left = at > 0
            part[here[left], at[left] - 1] = self._rank(new[here[left], at[left] - 1], new[here[left], at[left]])
            ids[live], rank[live] = new, part
        counts = (ids >= 0).sum(axis=1)
        flat = ids[ids >= 0].astype("<u4")
        return [flat[a:b] for a, b in zip(*spans(counts))]

    def _merge_long(self, word: bytes) -> np.ndarray:
        """The same for one word of any length, with a heap of pairs."""
        ids = [*self.inner[np.frombuffer(word, np.uint8)].tolist()]
        ids[-1] = int(self.final[word[-1]])
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        get = self.rank_of.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[r]), -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < len(ids) and (r := get(ids[k] << 32 | ids[after[k]])) is not None:
                    heapq.heappush(heap, (r, k, ids[k], ids[after[k]]))
        return np.array([i for i in ids if i >= 0], dtype="<u4")


def _letter_bytes() -> dict[str, int]:
    return {c: b for b, c in enumerate(letters_of_bytes())}


# ---------------------------------------------------------------- workers

_models: dict[str, WordBpe] = {}
_coders: dict[tuple[str, str], Coder] = {}


def model(path: str) -> WordBpe:
    if path not in _models:
        _models[path] = WordBpe(path)
    return _models[path]


def cut_pieces(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pieces of a string column between ASCII white space, the number of each piece in a row, and where each text's begin."""
    cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = pc.dictionary_encode(cut.flatten())
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.dictionary.to_pylist(), np.array(coded.indices, dtype=np.int32), np.asarray(cut.offsets) - cut.offsets[0].as_py()


class Coder:
    """Encodes and decodes with one vocabulary and one automaton."""

    def __init__(self, path: str, lexicon: str):
        self.bpe, self.automaton = model(path), Automaton(lexicon)
        self.known: dict[str, bytes] = {"": b""}
        self.spaced = pa.array([x + b" " for x in self.bpe.strings], pa.binary())

    def _learn(self, words: list[str]) -> None:
        spelled = [w.encode() for w in words]
        places = self.automaton.find(spelled)
        unseen = np.flatnonzero(places < 0).tolist()
        self.known.update((words[i], x.tobytes()) for i, x in zip(unseen, self.bpe.merge([spelled[i] for i in unseen])))
        seen = np.flatnonzero(places >= 0)
        at, flat = self.automaton.at, self.automaton.ids.tobytes()
        starts, ends = (at[places[seen]] * 4).tolist(), (at[places[seen] + 1] * 4).tolist()
        self.known.update((words[i], flat[a:b]) for i, a, b in zip(seen.tolist(), starts, ends))

    def _ids(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > CACHE:
            for word in list(islice(self.known, CACHE // 2, None)):
                del self.known[word]
        pairs = [self.bpe.core_and_tail(x) for x in pieces]
        odd = {i: self.bpe.words(pieces[i].encode()) for i, pair in enumerate(pairs) if pair is None}
        known = self.known
        new = {w for pair in pairs if pair for w in pair if w not in known}
        new.update(w for x in odd.values() for w in map(_as_text, x) if w is not None and w not in known)
        self._learn(list(new))
        out = [known[pair[0]] + known[pair[1]] if pair else b"" for pair in pairs]
        for i, words in odd.items():
            out[i] = b"".join([struct.pack("<I", w) if isinstance(w, int) else known[w.decode()] for w in words])
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A string column (nulls as empty) -> all ids in a row, and the number of each text's."""
        pieces, codes, offsets = cut_pieces(texts)
        packed = pa.array(self._ids(pieces), pa.binary()).take(pa.array(codes))
        run = np.frombuffer(packed.buffers()[1], np.int32, len(codes) + 1, 4 * packed.offset) // 4
        return np.frombuffer(packed.buffers()[2] or b"", "<u4", int(run[-1])), (run[offsets[1:]] - run[offsets[:-1]]).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The text of each run of ids: their strings, joined by a space."""
        strings = self.spaced.take(pa.array(ids))
        run = np.frombuffer(strings.buffers()[1], np.int32, len(ids) + 1, 4 * strings.offset)
        octets = memoryview(strings.buffers()[2]) if len(ids) else memoryview(b"")
        ends = np.cumsum(counts)
        return [bytes(octets[a : max(a, b - 1)]) for a, b in zip(run[ends - counts].tolist(), run[ends].tolist())]


def _as_text(word: bytes | int) -> str | None:
    return None if isinstance(word, int) else word.decode()


def coder(path: str, lexicon: str) -> Coder:
    if (path, lexicon) not in _coders:
        _coders.clear()
        _coders[path, lexicon] = Coder(path, lexicon)
    return _coders[path, lexicon]


# ---------------------------------------------------------------- Spark


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """documents(text) -> word, n over all texts. Tasks add words up before the shuffle."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, words = model(path), Counter()

        def hand_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()).cast(pa.binary()), pa.array(words.values(), pa.int64())], ["word", "n"])
            words.clear()
            return out

        for batch in groups(batches, "text", PIECE):
            pieces, codes, _ = cut_pieces(batch.column(0))
            for piece, n in zip(pieces, np.bincount(codes, minlength=len(pieces)).tolist()):
                pair = bpe.core_and_tail(piece)
                for word in pair or map(_as_text, bpe.words(piece.encode())):
                    if word:
                        words[word] += n
            if len(words) > CACHE:
                yield hand_on()
        yield hand_on()

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, size: int) -> list[bytes]:
    """Up to ``size`` most frequent words: all with at least some count, found from a histogram with 6 leading bits of each count, so at most size rows reach the driver."""
    counts = materialize(counts.where((F.col("n") > 1) & (F.length("word") <= LONGEST)), "words")
    shift = F.greatest(F.length(F.bin("n")) - 6, F.lit(0))
    step = F.call_function("shiftleft", F.call_function("shiftright", F.col("n"), shift), shift)
    least, total = None, 0
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r.step):  # some 2,000 rows at most
        if (total := total + r.words) > size:
            break
        least = r.step
    return [] if least is None else sorted(bytes(r.word) for r in counts.where(F.col("n") >= least).select("word").collect())


def compile_lexicon(docs: DataFrame, path: str, size: int = LEXICON) -> str:
    """Compile the most frequent words of all documents and ship the file; returns its name for SparkFiles."""
    words = frequent(word_counts(docs, path), size)
    content = build_automaton(words, [x.tolist() for x in model(path).merge(words)])
    name = f"lexicon-{hashlib.sha256(content).hexdigest()[:24]}.twa"
    context = docs.sparkSession.sparkContext
    if (context.applicationId, name) not in _sent:
        local = os.path.join(tempfile.mkdtemp(), name)
        with open(local, "wb") as f:
            f.write(content)
        context.addFile(local)
        _sent.add((context.applicationId, name))
    return name


_sent: set[tuple[str, str]] = set()


def encode_decode(docs: DataFrame, path: str, size: int = LEXICON, digest: bool = False) -> DataFrame:
    """documents(doc_id, text) -> doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded (UTF-8).

    digest: ids_sha256 and decoded_sha256 (lowercase hex) in the place of ids and decoded, so these needn't leave the worker.
    """
    lexicon = compile_lexicon(docs, path, size)
    names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, SparkFiles.get(lexicon))
        for batch in groups(batches, "text", PIECE):
            ids, counts = own.encode(batch.column(1))
            octets = memoryview(ids.tobytes())
            packed = [octets[a:b] for a, b in zip(*spans(counts * 4))]
            decoded = own.decode(ids, counts)
            if digest:
                out = [pa.array([hashlib.sha256(x).hexdigest() for x in column], pa.string()) for column in (packed, decoded)]
            else:
                out = [pa.array(map(bytes, packed), pa.binary()), pa.array(decoded, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), *out], names)

    kinds = ("string", "string") if digest else ("binary", "string")
    schema = f"doc_id long, n_tokens long, {names[2]} {kinds[0]}, {names[3]} {kinds[1]}"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
