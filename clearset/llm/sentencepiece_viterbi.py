"""SentencePiece encoding and decoding by a streaming Viterbi search.

Many texts are searched side by side in numpy, one step a character.  The search keeps the best
score of the last ``longest`` boundaries of each text only, ``longest`` being the length of the
longest piece: no piece reaches further back.  Backpointers are kept from the last commit on;
whenever the backpointers of all boundaries that a later piece can still start from lead through
one boundary, the ids up to it are committed and the backpointers before it forgotten.

A boundary that no piece of the vocabulary spans is such a point whatever the scores are.  For
vocabularies whose pieces hold the space mark only at their beginning (or consist of marks)
every word begins with one; texts are then cut there, and each different word of a batch goes
through the stream once.  Under other vocabularies whole texts do.

The best sum of scores is what a unigram model asks for.  The scores of a BPE model are ranks
of merges; its own ids come from merging in that order.  ``search="pairs"`` finds these by the same
stream: merging gives pieces in a row exactly if it gives each two neighbours of them, so each
boundary has one last piece, the one that can stand behind the last piece of the boundary
where it begins.  ``search="merges"`` is the library's encoder, word by word, texts that cannot be cut whole.

Scores are those of the model file: best sum, longest last piece among equal sums.  A
character without a piece counts ``UNKNOWN_PENALTY`` less than the worst piece and becomes
its UTF-8 bytes where the model has byte pieces, else the unknown id.

Defined cases: a null or empty text has no pieces and decodes to an empty text; of texts of any
length the search holds a window, beside the text and its ids; repeated rows are encoded each; an empty table gives
an empty result; extra columns stay, but columns named piece_ids, n_pieces, ids_crc32 or
round_trip give way to the operator's own.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial
from itertools import chain, count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearset.llm.text import give_back, small_batches

MARK = "▁"
UNKNOWN_PENALTY = 10.0
LANES = 1024
#: Stands behind the end of a text; no character has this code.
NONE = np.uint32(0x110000)
PIECE_CHARS = 1 << 20
#: Characters of different words that op9 keeps, with their ids, from one batch of a task to the next.
KNOWN_CHARS = 1 << 22
_MIX, _SEED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x1F83D9ABFB41BD6B)


@dataclass
class Vocabulary:
    pieces: list[str]  # by id
    scores: np.ndarray
    usable: np.ndarray  # ids that text can be cut into
    byte_ids: np.ndarray | None  # id of each byte value, if all have one
    unk_id: int
    ids: dict[str, int] = field(init=False)
    longest: int = field(init=False)
    unknown: float = field(init=False)
    words_apart: bool = field(init=False)
    merges: Merges | None = field(init=False, default=None)  # made when first asked for
    processor: object = field(init=False, default=None)  # the library's, where the vocabulary comes from a model file

    def __post_init__(self) -> None:
        self.ids = {self.pieces[i]: int(i) for i in self.usable}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = float(self.scores[self.usable].min() if len(self.usable) else 0.0) - UNKNOWN_PENALTY
        self.words_apart = all(MARK not in p.lstrip(MARK) and (p[0] != MARK or p.count(MARK) in (1, len(p))) for p in self.ids)
        # hash table of the pieces for numpy: slot -> id, open addressing resolved when built
        names = sorted(self.ids)
        keys = np.array([self.hash_of(p) for p in names], np.uint64)
        if len(set(keys.tolist())) != len(keys):
            raise ValueError("two pieces share a 64-bit hash")
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array([self.ids[names[i]] for i in order], np.int32)
        # first place of each 20-bit beginning, so that a lookup needs a few steps only
        self.index = np.searchsorted(self.keys, np.arange(1 << 20, dtype=np.uint64) << np.uint64(44)).astype(np.int32)
        held = np.bincount((self.keys >> np.uint64(44)).astype(np.int64), minlength=1 << 20)
        self.steps, self.held = int(held.max()), held > 0

    @staticmethod
    def hash_of(piece: str) -> int:
        h = int(_SEED)
        for c in piece:
            h = ((h ^ ord(c)) * int(_MIX) + 1) & 0xFFFFFFFFFFFFFFFF
            h ^= h >> 29
        return h

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 for none."""
        out = np.full(hashes.size, -1, np.int32)
        hashes, shape = hashes.ravel(), hashes.shape
        beginning = (hashes >> np.uint64(44)).astype(np.int64)
        some = np.flatnonzero(self.held[beginning])  # most beginnings are those of no piece
        own, at = hashes[some], self.index[beginning[some]]
        for j in range(self.steps):
            k = np.minimum(at + j, len(self.keys) - 1)
            hit = self.keys[k] == own
            out[some[hit]] = self.key_ids[k[hit]]
        return out.reshape(shape)


class Merges:
    """Which pieces merging by the scores puts side by side: best score first, leftmost of equal ones."""

    #: Time at which a piece comes up: that of a character, and of a piece that merging never gives.
    CHARACTER, NEVER = -1, -2

    def __init__(self, v: Vocabulary):
        order = sorted(v.ids.items(), key=lambda p: -v.scores[p[1]])
        times = {p: t for t, (p, _) in enumerate(order)}
        n = len(v.pieces)
        self.n, self.time, self.left, self.right = n, np.full(n, self.NEVER), np.zeros(n, np.int64), np.zeros(n, np.int64)
        keys, at = [], []
        for piece, i in order:
            parts = list(piece)
            while len(parts) > 2:
                t, k = min((times.get(a + b, len(times)), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
                if t == len(times):
                    break
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            if len(parts) == 1:
                self.time[i] = self.CHARACTER
            elif len(parts) == 2 and all(p in v.ids for p in parts):
                self.time[i], self.left[i], self.right[i] = times[piece], v.ids[parts[0]], v.ids[parts[1]]
                keys.append(self.left[i] * n + self.right[i])
                at.append(times[piece])
        by_key = np.argsort(keys)
        self.keys, self.at = np.array([*np.array(keys, np.int64)[by_key], -1], np.int64), np.array([*np.array(at, np.int64)[by_key], n], np.int64)

    def beside(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging gives ``first`` and ``second`` (ids) of the text of both: going back in time, no
        two that meet between them would have been merged before what is undone."""
        out = self.time[second] > self.NEVER
        at = np.flatnonzero(out)
        a, b, before = first[at], second[at], np.full(len(at), self.n)
        while len(at):
            key = a * self.n + b
            k = np.searchsorted(self.keys[:-1], key)
            merged = (self.keys[k] == key) & (self.at[k] < before)
            out[at[merged]] = False
            ta, tb = self.time[a], self.time[b]
            going = ~merged & ((ta >= 0) | (tb >= 0))
            at, a, b, ta, tb = at[going], a[going], b[going], ta[going], tb[going]
            later = ta > tb  # of equal pieces the left one comes up first
            before = np.where(later, ta, tb + 1)
            a, b = np.where(later, self.right[a], a), np.where(later, b, self.left[b])
        return out


def load_vocabulary(path: str) -> Vocabulary:
    """Pieces and scores of a SentencePiece model file."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    pieces = [m.id_to_piece(i) for i in range(n)]
    scores = np.array([m.get_score(i) for i in range(n)])
    apart = np.array([m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i) for i in range(n)])
    by_byte = {pieces[i]: i for i in range(n) if m.is_byte(i)}
    byte_ids = np.array([by_byte[f"<0x{b:02X}>"] for b in range(256)], np.int32) if len(by_byte) == 256 else None
    v = Vocabulary(pieces, scores, np.flatnonzero(~apart), byte_ids, m.unk_id())
    v.processor = m
    return v


class StreamingViterbi:
    """Encodes ``lanes`` texts that are fed side by side, some characters of each at a time."""

    def __init__(self, vocabulary: Vocabulary, lanes: int = 1):
        v = self.v = vocabulary
        self.chunk = 2 * v.longest
        self.scores = np.append(v.scores, -np.inf)
        self.lane = np.arange(lanes)  # texts that go on
        self.end = 0  # boundary that is reached
        self.done = np.zeros(lanes, np.int64)  # last committed boundary
        self.best = np.full((lanes, v.longest), -np.inf)  # best scores of the boundaries in the window, the last one latest
        self.best[:, -1] = 0
        self.tail = np.zeros((lanes, 0), np.uint32)  # characters that a piece can still begin with
        # last piece of each boundary after ``base``: its length and id, or -1 - code point for a character without one
        self.base = 0
        self.length, self.piece = np.zeros((lanes, 0), np.int64), np.zeros((lanes, 0), np.int32)
        self.out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # committed (text, boundary, id)
        self.most_kept = 0

    def step(self, codes: np.ndarray) -> None:
        """Move over the next characters (lanes x characters)."""
        v, (n, size) = self.v, codes.shape
        before = self.tail.shape[1]
        chars = np.concatenate([self.tail, codes], axis=1)
        window = min(v.longest, chars.shape[1])  # no piece is longer than what is there
        wide = chars.astype(np.uint64)
        # pieces by their end and length; longer ones first: they win ties
        ids = np.full((n, size, window), -1, np.int32)
        hashes = np.full(chars.shape, _SEED)
        for k in range(1, window + 1):
            hashes = (hashes[:, : chars.shape[1] - k + 1] ^ wide[:, k - 1 :]) * _MIX + np.uint64(1)
            hashes ^= hashes >> np.uint64(29)
            first = max(0, before + 1 - k)  # earlier ones end before these characters
            ids[:, first + k - 1 - before :, window - k] = v.find(hashes[:, first:])
        choice = self.choose(ids)
        piece = np.take_along_axis(ids, choice[:, :, None], axis=2)[:, :, 0]
        self.length = np.concatenate([self.length, window - choice], axis=1)
        self.piece = np.concatenate([self.piece, np.where(piece < 0, -1 - codes.astype(np.int64), piece).astype(np.int32)], axis=1)
        self.tail, self.end = chars[:, max(0, chars.shape[1] - v.longest + 1) :], self.end + size
        self.most_kept = max(self.most_kept, self.length.shape[1])

    def choose(self, ids: np.ndarray) -> np.ndarray:
        """Places of the last pieces of the next boundaries among ``ids``, those of the best sums of scores."""
        n, size, window = ids.shape
        gain = self.scores[ids]
        alone = gain[:, :, -1]
        alone[ids[:, :, -1] < 0] = self.v.unknown
        best = np.concatenate([self.best, np.empty((n, size))], axis=1)
        choice, rows, longest = np.empty((n, size), np.int64), np.arange(n), self.v.longest
        for t in range(size):
            reached = best[:, longest + t - window : longest + t] + gain[:, t]
            choice[:, t] = reached.argmax(axis=1)
            best[:, longest + t] = reached[rows, choice[:, t]]
        self.best = best[:, size:]
        return choice

    def commit(self) -> None:
        """Emit the ids of each text up to the boundary that all its paths in the window lead
        through, if any, and forget what all texts have committed."""
        if not len(self.lane):
            return
        alive = np.maximum(np.arange(self.end - self.v.longest + 1, self.end + 1), self.done[:, None])
        open_ = np.arange(len(alive))
        while len(open_):  # step the farthest boundary back until all meet
            own = alive[open_]
            far, near = own.max(axis=1), own.min(axis=1)
            apart = far > near
            open_, own, far = open_[apart], own[apart], far[apart]
            back = far - self.length[open_, far - self.base - 1]
            alive[open_] = np.where(own == far[:, None], back[:, None], own)
        self.emit(np.arange(len(alive)), alive[:, 0])
        self.done = alive[:, 0].copy()
        cut = int(self.done.min()) - self.base
        self.base += cut
        self.length, self.piece = self.length[:, cut:], self.piece[:, cut:]

    def emit(self, rows: np.ndarray, to: np.ndarray) -> None:
        """Walk back from the boundaries ``to`` to the last commits."""
        done = self.done[rows]
        while len(rows):
            going = to > done
            rows, to, done = rows[going], to[going], done[going]
            self.out.append((self.lane[rows], to, self.piece[rows, to - self.base - 1]))
            to = to - self.length[rows, to - self.base - 1]

    def close(self, ends: np.ndarray) -> None:
        """Emit what is left of the texts that end at boundaries up to the one reached, and leave them."""
        over = ends <= self.end
        self.emit(np.flatnonzero(over), ends[over])
        for name in ("lane", "done", "best", "tail", "length", "piece"):
            setattr(self, name, getattr(self, name)[~over])

    def result(self, lanes: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each text)."""
        who, where, what = (np.concatenate(x) for x in zip(*self.out)) if self.out else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((where, who))
        who, what = who[order], what[order]
        lens = np.bincount(who, minlength=lanes)
        missing = np.flatnonzero(what < 0)
        if len(missing):  # characters without a piece become one id or several
            own = [unknown_ids(self.v, chr(-1 - c)) for c in what[missing].tolist()]
            many = np.ones(len(what), np.int64)
            many[missing] = [len(x) for x in own]
            np.add.at(lens, who[missing], many[missing] - 1)
            begin = np.cumsum(many) - many
            what = np.repeat(what, many)
            for i, x in zip(begin[missing].tolist(), own):
                what[i : i + len(x)] = x
        return what.astype(np.int32), lens

    def feed(self, text: str) -> None:
        """The next characters of a single text."""
        for a in range(0, len(text), self.chunk):
            self.step(codes_of(text[a : a + self.chunk])[None])
            self.commit()

    def finish(self) -> list[int]:
        self.close(np.array([self.end]))
        return self.result(1)[0].tolist()


class PairedViterbi(StreamingViterbi):
    """The same over pairs: ``best`` holds the last piece of each boundary, FREE at the start and behind a
    character without a piece, where any piece can stand, OUT before the start."""

    FREE, OUT = -1, -2

    def __init__(self, vocabulary: Vocabulary, lanes: int = 1):
        super().__init__(vocabulary, lanes)
        if vocabulary.merges is None:
            vocabulary.merges = Merges(vocabulary)
        self.best = np.full((lanes, vocabulary.longest), self.OUT)
        self.best[:, -1] = self.FREE

    def choose(self, ids: np.ndarray) -> np.ndarray:
        """Places of the one last piece of each next boundary that can stand behind the one before it."""
        n, size, window = ids.shape
        last = np.concatenate([self.best, np.empty((n, size), np.int64)], axis=1)
        choice, rows = np.full((n, size), window - 1), np.arange(n)
        merges, longest = self.v.merges, self.v.longest
        for t in range(size):
            r, j = np.nonzero(ids[:, t] >= 0)
            before, own = last[r, longest + t - window + j], ids[r, t, j].astype(np.int64)
            fits = (before == self.FREE) & (merges.time[own] > merges.NEVER)
            both = np.flatnonzero(before >= 0)
            fits[both] = merges.beside(before[both], own[both])
            choice[r[fits], t] = j[fits]
            last[:, longest + t] = ids[rows, t, choice[:, t]]  # -1, a character without a piece, is FREE
        self.best = last[:, size:]
        return choice


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def unknown_ids(v: Vocabulary, c: str) -> list[int]:
    if v.byte_ids is None:
        return [v.unk_id]
    return [int(v.byte_ids[b]) for b in c.encode("utf-8", "surrogatepass")]


def stream(v: Vocabulary, escaped: str) -> list[int]:
    s = StreamingViterbi(v)
    s.feed(escaped)
    return s.finish()


def side_by_side(v: Vocabulary, words: list[str], kind: type[StreamingViterbi] = StreamingViterbi) -> tuple[np.ndarray, np.ndarray]:
    """One stream over words of any lengths, a lane each.  (ids, ids of each word)."""
    codes, ends = codes_of("".join(words)), np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(ends) - ends
    s = kind(v, len(words))
    s.close(ends)  # empty ones
    while len(s.lane):
        own = ends[s.lane]
        at = s.end + np.arange(min(s.chunk, int(own.max()) - s.end))
        inside = at < own[:, None]
        s.step(np.where(inside, codes[np.where(inside, begin[s.lane][:, None] + at, 0)], NONE))
        s.close(own)
        s.commit()
    return s.result(len(words))


def encode_words(v: Vocabulary, words: list[str], kind: type[StreamingViterbi] = StreamingViterbi) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, where those of each word begin, and how many they are)."""
    begin, lens = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    flat, n = [np.zeros(0, np.int32)], 0
    order = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")
    for a in range(0, len(order), LANES):  # words of about one length; what numpy works on stays small
        part = order[a : a + LANES]
        ids, counts = side_by_side(v, [words[i] for i in part], kind)
        flat.append(ids)
        begin[part], lens[part] = n + np.cumsum(counts) - counts, counts
        n += len(ids)
    return np.concatenate(flat), begin, lens


def merge_words(v: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same by the library's encoder; the library puts a mark before each word itself, but
    none before an empty one."""
    own = v.processor.encode([w[1:] for w in words], num_threads=1)
    alone = [v.ids[MARK]] if MARK in v.ids else unknown_ids(v, MARK)
    own = [alone if w == MARK else ids for w, ids in zip(words, own)]
    lens = np.fromiter(map(len, own), np.int64, len(own))
    return np.fromiter(chain.from_iterable(own), np.int32, int(lens.sum())), np.cumsum(lens) - lens, lens


def split_marks(escaped: str) -> list[str]:
    """Cut before each mark that follows another character."""
    first, *rest = escaped.split(MARK)
    if MARK * 2 not in escaped:
        return ([first] if first else []) + [MARK + w for w in rest]
    out, marks = ([first] if first else []), ""
    for w in rest:
        marks += MARK
        if w:
            out.append(marks + w)
            marks = ""
    return out + [marks] if marks else out


SEARCHES = {"scores": encode_words, "pairs": partial(encode_words, kind=PairedViterbi), "merges": merge_words}


class KnownWords:
    """Different words with their ids by each search.  A word is searched when it is first met; the table is
    begun anew once it holds more than ``most`` characters."""

    def __init__(self, v: Vocabulary, searches: Sequence[str], most: int = 0):
        self.v, self.searches, self.most = v, searches, most
        self.forget()

    def forget(self) -> None:
        none = np.zeros(0, np.int64)
        self.names: dict[str, int] = defaultdict(count().__next__)
        self.chars = 0
        # by search: ids, where those of each word begin, and how many they are
        self.coded = [(none.astype(np.int32), none, none) for _ in self.searches]

    def numbers(self, words: list[str]) -> np.ndarray:
        """The place of each word in the table."""
        if self.chars > self.most:
            self.forget()
        before = len(self.names)
        out = np.fromiter(map(self.names.__getitem__, words), np.int64, len(words))
        new = list(islice(self.names, before, None))
        if new:
            self.chars += sum(map(len, new))
            for k, search in enumerate(self.searches):
                flat, begin, lens = self.coded[k]
                ids, at, n = SEARCHES[search](self.v, new)
                self.coded[k] = np.concatenate([flat, ids]), np.concatenate([begin, at + len(flat)]), np.concatenate([lens, n])
        return out


def encode_batch(v: Vocabulary, texts: list[str], *searches: str, known: KnownWords | None = None) -> list[np.ndarray]:
    """For each search, "scores" if none is named: ids of all texts, ids of each text.  ``known``: words
    of earlier batches, by the same searches."""
    searches = searches or ("scores",)
    known = known or KnownWords(v, searches)
    words: list[str] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if t:
            escaped = MARK + t.replace(" ", MARK)
            own = split_marks(escaped) if v.words_apart else [escaped]
            sizes[i] = len(own)
            words += own
    if not words:
        return [np.zeros(0, np.int32), sizes] * len(searches)
    code = known.numbers(words)
    edge, out = np.r_[0, np.cumsum(sizes)], []
    for flat, begin, lens in known.coded:
        n = lens[code]
        before = np.r_[0, np.cumsum(n)]
        out += [flat[np.repeat(begin[code] - before[:-1], n) + np.arange(n.sum())], before[edge[1:]] - before[edge[:-1]]]
    return out


class Decoder:
    def __init__(self, v: Vocabulary):
        bytes_of = [p.replace(MARK, " ").encode("utf-8", "surrogatepass") for p in v.pieces]
        if v.byte_ids is not None:
            for b, i in enumerate(v.byte_ids):
                bytes_of[i] = bytes([b])
        self.flat = np.frombuffer(b"".join(bytes_of), np.uint8)
        self.size = np.fromiter(map(len, bytes_of), np.int64, len(bytes_of))
        self.begin = np.cumsum(self.size) - self.size

    def decode(self, ids: np.ndarray) -> str:
        n = self.size[ids]
        at = np.repeat(self.begin[ids] - np.cumsum(n) + n, n) + np.arange(n.sum())
        text = self.flat[at].tobytes().decode("utf-8", "surrogatepass")
        return text[1:] if text[:1] == " " else text  # the mark put before the text


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One vocabulary for each worker process."""
    if path not in _loaded:
        _loaded[path] = load_vocabulary(path)
    return _loaded[path]


def batches_of(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive runs of rows of about PIECE_CHARS bytes."""
    first, n = 0, 0
    for i, size in enumerate(sizes.tolist()):
        n += size
        if n >= PIECE_CHARS or i + 1 == len(sizes):
            yield first, i + 1
            first, n = i + 1, 0


def encode(docs: DataFrame, model_path: str, text: str = "text", verify: bool = True, digest: bool = False, search: str = "scores", also: str | None = None, known_chars: int = 0) -> DataFrame:
    """``docs`` with piece_ids and, with ``verify``, round_trip: whether they decode to the text.
    ``digest`` gives n_pieces and ids_crc32 in place of the ids.  ``search``: "scores" (best sum),
    "pairs" (the model's own ids, by the stream) or "merges" (the same by the library); ``also`` adds the columns of a second one, in the same
    pass, with its name in front.  Encoding and decoding share a task; batches are cut into
    pieces, so that a worker holds a few megabytes at a time, and beside them different words of up to
    about ``known_chars`` characters with their ids, which are not searched again."""
    small_batches(docs.sparkSession)
    searches = [search, also] if also else [search]
    kinds = {"n_pieces": "long", "ids_crc32": "long"} if digest else {"piece_ids": "array<int>"}
    if verify:
        kinds["round_trip"] = "boolean"
    added = {f"{front}{name}": kind for front in ["", f"{also}_"][: len(searches)] for name, kind in kinds.items()}
    kept = [c for c in docs.columns if c not in {"piece_ids", "n_pieces", "ids_crc32", "round_trip", *added}]
    fields = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(kept).schema), *(f"`{name}` {kind}" for name, kind in added.items())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        v = vocabulary(model_path)
        decoder, known = Decoder(v), KnownWords(v, searches, known_chars) if known_chars else None
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            given = [c for c, name in zip(batch.columns, batch.schema.names) if name in kept]
            for a, b in batches_of(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)):
                texts = [t or "" for t in column.slice(a, b - a).to_pylist()]
                coded, new = encode_batch(v, texts, *searches, known=known), []
                for ids, counts in zip(coded[::2], coded[1::2]):
                    edge = np.r_[0, np.cumsum(counts)]
                    if digest:
                        raw = memoryview(ids.astype("<u4").tobytes())
                        crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(edge[:-1], edge[1:])]
                        new += [pa.array(counts, pa.int64()), pa.array(crc, pa.int64())]
                    else:
                        new.append(pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(ids.astype(np.int32))))
                    if verify:
                        new.append(pa.array([decoder.decode(ids[x:y]) == t for x, y, t in zip(edge[:-1], edge[1:], texts)], pa.bool_()))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in given), *new], [*kept, *added])
        known = None
        give_back()

    return docs.select(*kept).mapInArrow(run, ", ".join(fields))


def decode(docs: DataFrame, model_path: str, ids: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of an array of piece ids added; a null array gives an empty text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(vocabulary(model_path))
        for column in batches:
            yield pd.Series([decoder.decode(x) if x is not None else "" for x in column], dtype=object)

    return docs.withColumn(out, F.pandas_udf(run, "string")(F.col(ids)))


def op9_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Per document the digest of its piece ids and whether they decode to the text: of the best
    sum of scores, and (model_...) of the model's own merges."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode(docs, path, digest=True, also="merges", known_chars=KNOWN_CHARS)
    named = coded.withColumnsRenamed({f"merges_{c}": f"model_{c}" for c in ("n_pieces", "ids_crc32", "round_trip")})
    return named.select("doc_id", "n_pieces", "ids_crc32", "round_trip", "model_n_pieces", "model_ids_crc32", "model_round_trip")
