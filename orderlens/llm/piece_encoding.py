"""SentencePiece encoding and decoding of texts of any length (BPE models with byte fallback).

A sequence of pieces is the model's encoding of a text exactly when every two
neighbours are *compatible*: encoding the two joined gives the same two pieces
again.  (A merge across a border would already happen with the two neighbours
alone.)  So encoding is a path through a lattice whose steps weigh 0 when
compatible and minus infinity when not, and the one path of weight 0 is sought.
That makes it a max-plus scan: a giant text is cut into chunks at arbitrary
places, each chunk yields the matrix from the states at its left cut to those at
its right cut, the matrices are combined associatively, and each chunk is then
traced back on its own between its two resolved states.  A state at a cut is the
piece that holds the character before the cut.

No piece continues after a character that is followed by the blank mark, so
paths meet at every word start, and words are looked up in a bounded memo.

The vocabulary is read on the driver from a given model file and travels with
the tasks (its size is fixed by the model).  Null text is encoded like the
empty text: no pieces; equal rows give equal rows, and an empty table none.  Decoding returns the text; as in the model itself, the
blank mark (U+2581) inside a text decodes to a blank.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import Scratch, free_name

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Characters of a chunk; texts of up to twice as many are encoded in one piece.
CHUNK = 1 << 13
BREAK = "\n"
#: Words, and characters in them, that a task's memo holds before it starts anew.
MEMO = 60_000
MEMO_CHARACTERS = 1 << 20
#: Texts that a task turns into ids or back at once; chunks that it works on at once.
SLICE = 256
CHUNKS = 32
#: Longest run of a word's characters that is encoded by merging.
SHORT = 24
#: Strings that are merged at once.
STRINGS = 4096
NEG = -np.inf


class Vocabulary:
    """Pieces, ranks and byte pieces of a model; plain data that travels with tasks."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], unknown: int, surface: list[bytes]):
        self.pieces, self.byte_ids, self.unknown, self.surface = pieces, byte_ids, unknown, surface
        self.longest = max(map(len, pieces))
        self.token = hashlib.sha256(repr((pieces, byte_ids, unknown)).encode("utf-8", "surrogatepass")).hexdigest()
        #: Neighbouring characters that some piece holds; a merge never crosses any others.
        self.neighbours = {piece[i:i + 2] for piece in pieces for i in range(len(piece) - 1)}

    @classmethod
    def load(cls, model_file: str = MODEL) -> "Vocabulary":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for probe in ("a  b ", "é́ﬁ\t\nx", " A 　"):
            if model.normalize(probe) != MARK + probe.replace(" ", MARK):
                raise ValueError("only models that keep characters and put one blank in front are supported")
        size = model.get_piece_size()
        byte_ids, pieces, surface = [0] * 256, {}, []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                surface.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                surface.append(b"" if model.is_control(i) else " ⁇ ".encode())
            else:
                if model.is_unused(i) or MARK in piece.lstrip(MARK):
                    raise ValueError(f"unsupported piece {piece!r}")
                pieces[piece] = (i, model.get_score(i))
                surface.append(piece.replace(MARK, " ").encode())
        if not any(model.is_byte(i) for i in range(size)):
            raise ValueError("the model has no byte pieces")
        return cls(pieces, byte_ids, model.unk_id(), surface)


class Merges:
    """The model's merges on many short strings at once (NumPy)."""

    #: Numbers of characters that are no piece: beyond those of the pieces.
    SHIFT = 21

    def __init__(self, vocabulary: Vocabulary):
        pieces = vocabulary.pieces
        size = 1 + max(i for i, _ in pieces.values())
        self.unknown = size
        self.score = np.full(size + 1, NEG)
        for i, score in pieces.values():
            self.score[i] = score
        single = sorted((ord(p), i) for p, (i, _) in pieces.items() if len(p) == 1)
        self.points = np.array([c for c, _ in single], np.int64)
        self.numbers = np.array([i for _, i in single], np.int64)
        number = lambda x: pieces[x][0] if x in pieces else size + ord(x) if len(x) == 1 else None
        keys, merged = [], []
        for piece, (i, _) in pieces.items():
            for cut in range(1, len(piece)):
                a, b = number(piece[:cut]), number(piece[cut:])
                if a is not None and b is not None:
                    keys.append(a << self.SHIFT | b)
                    merged.append(i)
        # open addressing with linear probing, filled a round of probes at a time
        bits = max(4, (4 * len(keys)).bit_length())
        self.mask, self.down = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.merged = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        left, value = np.array(keys, np.int64), np.array(merged, np.int64)
        slot = self.slot(left)
        while len(left):
            free = np.flatnonzero(self.keys[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            take = free[first]
            self.keys[slot[take]], self.merged[slot[take]] = left[take], value[take]
            rest = np.ones(len(left), bool)
            rest[take] = False
            left, value, slot = left[rest], value[rest], (slot[rest] + 1) & self.mask

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.down).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of the piece that ``a`` and ``b`` make, or -1; negative numbers make none."""
        out = np.full(len(a), -1, np.int64)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        key = a[todo] << self.SHIFT | b[todo]
        slot = self.slot(key)
        while len(todo):
            held = self.keys[slot]
            hit = held == key
            out[todo[hit]] = self.merged[slot[hit]]
            on = ~hit & (held >= 0)
            todo, key, slot = todo[on], key[on], (slot[on] + 1) & self.mask
        return out

    def encode(self, strings: list[str]) -> list[list[int] | bytes]:
        """Piece numbers of each string (none empty) as bytes; a list where a character is no piece.

        The strings' parts lie one after the other; in a round every string merges its best pair.
        """
        size = np.array([len(x) for x in strings])
        ends = np.cumsum(size)
        begins = starts = ends - size
        point = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self.points, point), len(self.points) - 1)
        ids = np.where(self.points[at] == point, self.numbers[at], self.unknown + point)
        after = np.append(ids[1:], -1)
        after[ends - 1] = -1
        pair = self.find(ids, after)
        score = self.score[pair]
        # a finished piece stands where its first character stood
        out, place = np.full(len(ids), -1, np.int64), np.arange(len(ids))
        while True:
            best = np.maximum.reduceat(score, starts)
            on = best > NEG
            if not on.all():
                stay = np.repeat(on, size)
                out[place[~stay]] = ids[~stay]
                ids, place, pair, score, size, best = ids[stay], place[stay], pair[stay], score[stay], size[on], best[on]
                if not len(size):
                    break
                starts = np.cumsum(size) - size
            hits = np.flatnonzero(score == np.repeat(best, size))
            first = hits[np.searchsorted(hits, starts)]
            made = ids[first] = pair[first]
            stay = np.ones(len(ids), bool)
            stay[first + 1] = False
            ids, place, pair, score, size = ids[stay], place[stay], pair[stay], score[stay], size - 1
            ends = np.cumsum(size)
            starts = ends - size
            first -= np.arange(len(first))      # a part has gone from each string before
            pair[first] = self.find(made, np.where(first + 1 < ends, ids[np.minimum(first + 1, len(ids) - 1)], -1))
            score[first] = self.score[pair[first]]
            inner = first > starts
            before = first[inner] - 1
            pair[before] = self.find(ids[before], made[inner])
            score[before] = self.score[pair[before]]
        used = out >= 0
        odd = np.logical_or.reduceat(out >= self.unknown, begins)
        stops = np.cumsum(np.add.reduceat(used, begins, dtype=np.int64))
        out = out[used].astype(np.int32)
        raw = out.tobytes()
        return [out[a:b].tolist() if o else raw[4 * a:4 * b]
                for a, b, o in zip([0, *stops.tolist()], stops.tolist(), odd.tolist())]


class Lattice:
    """Paths of compatible pieces over strings of marks and characters."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pieces = vocabulary.pieces
        self.longest = vocabulary.longest
        self.neighbours = vocabulary.neighbours
        self.joins_lines = any(BREAK in pair for pair in self.neighbours)
        self.known: dict[tuple[str, str], bool] = {}
        self.parts = Memo(self.encode_part)
        self.words = Memo(lambda w: self.encode_run(marked(w)))
        self.heads = Memo(self.encode_run)
        self.run = RUN if self.joins_lines else LINE_RUN

    @cached_property
    def merges(self) -> Merges:
        return Merges(self.v)

    def merge(self, text: str) -> list[str]:
        """The model's own procedure on a short string: best pair first, leftmost of equals."""
        get, parts = self.pieces.get, list(text)
        worst = (0, NEG)
        scores = [get(a + b, worst)[1] for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == NEG:
                break
            i = scores.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], worst)[1]
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], worst)[1]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        key = (left, right)
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= MEMO:
                self.known.clear()
            found = self.known[key] = self.merge(left + right) == [left, right]
        return found

    def fits(self, left: str, right: str) -> bool:
        return not left or left[-1] != MARK and right[0] == MARK or self.compatible(left, right)

    def path(self, text: str) -> list[str]:
        """Encoding of a string that starts and ends at borders of pieces: every prefix
        has one encoding, so one last piece is kept for each position."""
        pieces, longest = self.pieces, self.longest
        last = [""] * (len(text) + 1)
        for end in range(1, len(text) + 1):
            for size in range(min(end, longest), 0, -1):
                piece = text[end - size:end]
                if size == 1 or piece in pieces:
                    before = last[end - size]
                    if (end == size or before) and (not before or self.compatible(before, piece)):
                        last[end] = piece
                        break
        out, end = [], len(text)
        while end:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def ids(self, parts: list[str]) -> bytes:
        out = []
        for piece in parts:
            found = self.pieces.get(piece)
            if found is not None:
                out.append(found[0])
            else:
                out += [self.v.byte_ids[b] for b in piece.encode()]
        return np.array(out, np.int32).tobytes()

    def encode_part(self, part: str) -> bytes:
        # on a few characters the merges themselves are cheaper than the lattice, with the same result
        return self.ids(self.merge(part) if len(part) <= SHORT else self.path(part))

    def encode_run(self, run: str) -> bytes:
        """Ids of a string between two borders, cut where no piece joins two characters."""
        known, begin, out = self.neighbours, 0, []
        for i in range(1, len(run)):
            if run[i - 1:i + 1] not in known:
                out.append(self.parts[run[begin:i]])
                begin = i
        out.append(self.parts[run[begin:]])
        return b"".join(out)

    def plain(self, text: str) -> bool:
        """Whether every blank of ``text`` stands between two words, so that words can be split off by blanks."""
        return not (MARK in text or "  " in text or text[0] == " " or text[-1] == " "
                    or BREAK + " " in text or " " + BREAK in text or self.joins_lines)

    def learn(self, memo: "Memo", strings: set[str], form=str) -> None:
        """Put the short ones of ``strings`` into ``memo``, all at once; ``form`` gives what is encoded of one."""
        new = [x for x in strings.difference(memo) if 0 < len(x) < SHORT]
        if len(memo) + len(new) > MEMO:
            # frequent words, which are in most slices, stay
            kept = {x: memo[x] for x in strings if x in memo}
            memo.clear()
            memo.update(kept)
            memo.characters = sum(map(len, kept))
        memo.characters += sum(map(len, new))
        new.sort(key=len)       # strings of a length end in about the same round
        for lo in range(0, len(new), STRINGS):
            some = new[lo:lo + STRINGS]
            for x, ids in zip(some, self.merges.encode([form(x) for x in some])):
                memo[x] = ids if isinstance(ids, bytes) else self.spelled(ids)

    def spelled(self, ids: list[int]) -> bytes:
        out = []
        for i in ids:
            out += [i] if i < self.merges.unknown else [
                self.v.byte_ids[b] for b in chr(i - self.merges.unknown).encode("utf-8", "surrogatepass")]
        return np.array(out, np.int32).tobytes()

    def learn_all(self, texts: list[str]) -> None:
        """Put the words and runs of ``texts`` into the memos, all at once."""
        words: set[str] = set()
        runs: set[str] = set()
        for text in texts:
            if text and self.plain(text):
                words.update(split(text))
            elif text:
                runs.update(self.run.findall(MARK + text.replace(" ", MARK)))
        self.learn(self.words, words, marked)
        self.learn(self.heads, runs)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        self.learn_all(texts)
        return [self.encode(text) for text in texts]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text."""
        if not text:
            return b""
        if self.plain(text):
            return b"".join(map(self.words.__getitem__, split(text)))
        return b"".join(map(self.heads.__getitem__, self.run.findall(MARK + text.replace(" ", MARK))))

    # --- chunks of giant texts -------------------------------------------------

    def states(self, text: str, cut: int) -> list[tuple[int, int]]:
        """Pieces (start, end) of ``text`` that hold the character before ``cut``."""
        found = []
        for start in range(max(0, cut - self.longest), cut):
            for end in range(cut, min(len(text), start + self.longest) + 1):
                if end - start == 1 or text[start:end] in self.pieces:
                    found.append((start, end))
        return found

    def forward(self, text: str, entries: list[tuple[int, int]], stop: int, keep: bool = False):
        """States at the cut ``stop`` with the set (bit mask) of entries that reach them.

        With ``keep`` also the steps, for tracing back from a single entry.
        """
        active: dict[int, dict[str, int]] = {}
        steps: dict[tuple[int, int], tuple[int, int]] = {}
        for i, (start, end) in enumerate(entries):
            row = active.setdefault(end, {})
            row[text[start:end]] = row.get(text[start:end], 0) | 1 << i
        at = min(active)
        exits: dict[tuple[int, int], int] = {(s, e): 1 << i for i, (s, e) in enumerate(entries) if e >= stop}
        while at < stop:
            here = active.pop(at, None)
            if here:
                for size in range(1, min(self.longest, len(text) - at) + 1):
                    piece = text[at:at + size]
                    if size > 1 and piece not in self.pieces:
                        continue
                    mask = 0
                    for before, reached in here.items():
                        if self.fits(before, piece):
                            mask |= reached
                            steps[at, at + size] = (at - len(before), at) if keep else None
                    if mask:
                        end = at + size
                        if end >= stop:
                            exits[at, end] = exits.get((at, end), 0) | mask
                        else:
                            row = active.setdefault(end, {})
                            row[piece] = row.get(piece, 0) | mask
            at += 1
        return (exits, steps) if keep else exits

    def matrix(self, text: str, left: int, right: int, first: bool, final: bool):
        """(entries, exits, weights) of the chunk ``text[left:right]`` within its context."""
        entries = [(0, 0)] if first else self.states(text, left)
        exits = [s for s in self.states(text, right) if not final or s[1] == right]
        border = last_word_start(text, left + self.longest, right)
        if border is None:
            reached = self.forward(text, entries, right)
        else:
            head = first_word_start(text, left + self.longest, border)
            alive = 0
            for mask in [m for (_, end), m in self.forward(text, entries, head).items() if end == head]:
                alive |= mask
            # all words between the two borders can be passed: only the rest decides
            tail = self.forward(text, [(border, border)], right)
            reached = {state: alive for state in tail}
        weights = np.full((len(entries), len(exits)), NEG)
        for j, state in enumerate(exits):
            mask = reached.get(state, 0)
            for i in range(len(entries)):
                if mask >> i & 1:
                    weights[i, j] = 0.0
        return entries, exits, weights

    def middle(self, text: str, entry: tuple[int, int], leave: tuple[int, int]) -> tuple[int, int] | None:
        """Borders of the whole words between two states, if any."""
        if entry == leave and entry[1]:
            return None
        border = last_word_start(text, entry[1], leave[0])
        return None if border is None else (first_word_start(text, entry[1], border), border)

    def trace(self, text: str, entry: tuple[int, int], leave: tuple[int, int]) -> bytes:
        """Ids of the pieces after ``entry`` up to and with ``leave``."""
        if entry == leave and entry[1]:
            return b""
        found = self.middle(text, entry, leave)
        if found is None:
            return self.ids(self.back(text, entry, leave))
        head, border = found
        out = b"" if head == entry[1] else self.ids(self.back_to(text, entry, head))
        out += self.encode(unmarked(text[head:border]))
        return out + self.ids(self.back(text, (border, border), leave))

    def back_to(self, text: str, entry: tuple[int, int], border: int) -> list[str]:
        exits, steps = self.forward(text, [entry], border, keep=True)
        ends = [s for s in exits if s[1] == border]
        return self.walk(text, steps, entry, ends[0])

    def back(self, text: str, entry: tuple[int, int], leave: tuple[int, int]) -> list[str]:
        _, steps = self.forward(text, [entry], leave[0] + 1, keep=True)
        return self.walk(text, steps, entry, leave)

    @staticmethod
    def walk(text, steps, entry, state) -> list[str]:
        out = []
        while state != entry and state[1] > entry[1]:
            out.append(text[state[0]:state[1]])
            state = steps[state]
        return out[::-1]


#: The lattice of the last model used, with its bounded memos: a Python worker keeps it for its later tasks.
KEPT: dict[str, Lattice] = {}


def lattice_of(vocabulary: Vocabulary) -> Lattice:
    found = KEPT.get(vocabulary.token)
    if found is None:
        KEPT.clear()
        found = KEPT[vocabulary.token] = Lattice(vocabulary)
    return found


class Memo(dict):
    """Computes missing values; the owner empties it between texts when it is full."""

    def __init__(self, make):
        super().__init__()
        self.make, self.characters = make, 0

    def __missing__(self, key):
        self.fit(key)
        value = self[key] = self.make(key)
        return value

    def fit(self, key):
        """Make room for ``key``: a text without blanks is one long key."""
        self.characters += len(key)
        if len(self) >= MEMO or self.characters > MEMO_CHARACTERS:
            self.clear()
            self.characters = len(key)


RUN = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Where no piece joins a line feed to anything, runs end at line feeds too.
LINE_RUN = re.compile(f"{BREAK}|{MARK}+[^{MARK}{BREAK}]*|[^{MARK}{BREAK}]+")


def split(text: str) -> list[str]:
    """Words of a plain text: those that follow a line feed, no mark, begin with it."""
    return text.replace(BREAK, " " + BREAK).split(" ")


def marked(word: str) -> str:
    return word if word[:1] == BREAK else MARK + word


def unmarked(run: str) -> str:
    """The text whose marked form is ``run``, which is empty or begins with a mark."""
    return run[1:].replace(MARK, " ")


def first_word_start(text: str, lo: int, hi: int):
    """Smallest p in [lo, hi] where a mark follows another character."""
    p = max(lo, 1)
    while p <= hi:
        p = text.find(MARK, p, hi + 1)
        if p < 0:
            return None
        if text[p - 1] != MARK:
            return p
        p += 1
    return None


def last_word_start(text: str, lo: int, hi: int):
    """Largest p in [lo, hi) where a mark follows another character."""
    p = hi
    while True:
        p = text.rfind(MARK, max(lo, 1), p)
        if p < 0 or text[p - 1] != MARK:
            return p if p >= 0 else None


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product in the max-plus semiring; associative."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1) if a.size and b.size else np.full((a.shape[0], b.shape[1]), NEG)


def cuts(length: int, chunk: int = CHUNK) -> list[int]:
    """Ends of the chunks: equal steps, the rest added to the last."""
    count = max(1, length // chunk)
    return [chunk * k for k in range(1, count)] + [length]


def encode_task(vocabulary: Vocabulary, columns: list[str]):
    """Batches whose last column is the text: the text is replaced by its ids."""
    def run(batches):
        lattice = lattice_of(vocabulary)
        for batch in slices(batches):
            ids = lattice.encode_all(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [id_lists(ids)], columns + ["ids"])
    return run


def slices(batches, rows: int = SLICE):
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def id_lists(ids: list[bytes]) -> pa.Array:
    ends = np.zeros(len(ids) + 1, np.int64)
    np.cumsum([len(x) // 4 for x in ids], out=ends[1:])
    flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)


CHUNK_SCHEMA = "k int, chunks int, at bigint, left int, right int, piece string"


def chunk_task(columns: list[str], longest: int, chunk: int):
    """Batches whose last column is the text: one row per chunk, with context on both sides."""
    names = ["key", *columns, "k", "chunks", "at", "left", "right", "piece"]

    def run(batches):
        for batch in batches:
            rest = batch.columns[:-1]
            for row, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                key, marked = uuid.uuid4().hex, MARK + text.replace(" ", MARK)
                ends = cuts(len(marked), chunk)
                for k, end in enumerate(ends):
                    begin = ends[k - 1] if k else 0
                    lo, hi = max(0, begin - 2 * longest), min(len(marked), end + 2 * longest)
                    only = [pa.array([x], t) for x, t in (
                        (k, pa.int32()), (len(ends), pa.int32()), (lo, pa.int64()), (begin - lo, pa.int32()),
                        (end - lo, pa.int32()), (marked[lo:hi], pa.string()))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key])] + [c.slice(row, 1) for c in rest] + only, names)
    return run


def matrix_task(vocabulary: Vocabulary):
    def run(batches):
        lattice = lattice_of(vocabulary)
        for batch in slices(batches, CHUNKS):
            out = []
            for r in batch.to_pylist():
                entries, exits, w = lattice.matrix(
                    r["piece"], r["left"], r["right"], r["k"] == 0, r["k"] == r["chunks"] - 1)
                move = lambda states: [[s + r["at"], e + r["at"]] for s, e in states]
                out.append({"key": r["key"], "k": r["k"], "entries": move(entries), "exits": move(exits),
                            "open": [int(x) for x in np.flatnonzero(w == 0.0)]})
            yield pa.RecordBatch.from_pylist(out, MATRIX)
    return run


STATES = pa.list_(pa.list_(pa.int64()))
MATRIX = pa.schema([("key", pa.string()), ("k", pa.int32()), ("entries", STATES), ("exits", STATES),
                    ("open", pa.list_(pa.int64()))])


def resolve_task(frame):
    """The state at every cut of one text: forward products, then backwards from the end."""
    import pandas as pd

    frame = frame.sort_values("k")
    chunks = []
    for entries, exits, marks in zip(frame["entries"], frame["exits"], frame["open"]):
        entries, exits = [tuple(map(int, x)) for x in entries], [tuple(map(int, x)) for x in exits]
        w = np.full((len(entries), len(exits)), NEG)
        w.reshape(-1)[np.asarray(list(marks), int)] = 0.0
        chunks.append((entries, exits, w))
    reach = [np.zeros((1, 1))]
    for _, _, w in chunks:
        reach.append(max_plus(reach[-1], w))
    out, state = [], None
    for k in range(len(chunks) - 1, -1, -1):
        entries, exits, w = chunks[k]
        j = int(np.flatnonzero(reach[k + 1][0] == 0.0)[0]) if state is None else exits.index(state)
        i = int(np.flatnonzero(reach[k][0] + w[:, j] == 0.0)[0])
        state = entries[i]
        out.append((frame["key"].iloc[0], k, *entries[i], *exits[j]))
    return pd.DataFrame(out, columns=["key", "k", "in_start", "in_end", "out_start", "out_end"])


def trace_task(vocabulary: Vocabulary):
    def run(batches):
        lattice = lattice_of(vocabulary)
        for batch in slices(batches, CHUNKS):
            rows = batch.to_pylist()
            steps = [(r["piece"], (r["in_start"] - r["at"], r["in_end"] - r["at"]) if r["k"] else (0, 0),
                      (r["out_start"] - r["at"], r["out_end"] - r["at"])) for r in rows]
            spans = [lattice.middle(*x) for x in steps]
            lattice.learn_all([unmarked(text[x[0]:x[1]]) for (text, _, _), x in zip(steps, spans) if x])
            ids = [lattice.trace(*x) for x in steps]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["key"] for r in rows], pa.string()), pa.array([r["k"] for r in rows], pa.int32()),
                 id_lists(ids)], ["key", "k", "ids"])
    return run


def encode(docs: DataFrame, text_col: str = "text", out: str = "ids", model_file: str = MODEL,
           chunk: int = CHUNK) -> DataFrame:
    """``docs`` with the text column replaced by the array ``out`` of piece ids."""
    vocabulary = Vocabulary.load(model_file)
    scratch = Scratch(docs.sparkSession, "pieces")
    others = [c for c in docs.columns if c != text_col]
    rest = [f"c{i}" for i in range(len(others))]          # names that cannot clash with the steps' own
    plain = docs.select(*(F.col(f"`{c}`").alias(a) for c, a in zip(others, rest)),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    fields = ", ".join(f"{c} {t}" for c, t in plain.dtypes if c != "text")
    comma = ", " if fields else ""
    giant = F.length("text") >= 2 * chunk
    small = plain.where(~giant).mapInArrow(encode_task(vocabulary, rest), f"{fields}{comma}ids array<int>")

    chunks = scratch.write(plain.where(giant).mapInArrow(
        chunk_task(rest, vocabulary.longest, chunk), f"key string, {fields}{comma}{CHUNK_SCHEMA}"), "chunks")
    pieces = chunks.select("key", "k", "chunks", "at", "left", "right", "piece")
    matrices = pieces.mapInArrow(matrix_task(vocabulary), "key string, k int, entries array<array<bigint>>, "
                                                          "exits array<array<bigint>>, open array<bigint>")
    states = matrices.groupBy("key").applyInPandas(
        resolve_task, "key string, k int, in_start bigint, in_end bigint, out_start bigint, out_end bigint")
    traced = pieces.join(states, ["key", "k"]).mapInArrow(trace_task(vocabulary), "key string, k int, ids array<int>")
    # a text is one row of the input, so its ids are one row again
    joined = traced.groupBy("key").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))
    large = chunks.where("k = 0").select("key", *rest).join(joined, "key").select(*rest, "ids")
    both = small.unionByName(large)
    return both.select(*(F.col(a).alias(c) for c, a in zip(others, rest)), F.col("ids").alias(out))


def decode_task(surface: list[bytes], columns: list[str], keep: bool = False):
    """Batches whose last column is the ids: they are replaced by their text, or stay before it."""
    def run(batches):
        get = surface.__getitem__
        for batch in slices(batches):
            texts = []
            for ids in batch.column(batch.num_columns - 1):
                raw = b"".join(map(get, ids.values.to_numpy().tolist())) if ids.is_valid else b""
                texts.append(raw.decode("utf-8", "replace")[1:])
            rest = batch.columns if keep else batch.columns[:-1]
            yield pa.RecordBatch.from_arrays(rest + [pa.array(texts, pa.string())], columns + ["text"])
    return run


def decode(encoded: DataFrame, ids_col: str = "ids", out: str = "text", model_file: str = MODEL,
           keep: bool = False) -> DataFrame:
    """``encoded`` with the id array replaced by the text ``out``; with ``keep`` the ids stay before it."""
    vocabulary = Vocabulary.load(model_file)
    others = [c for c in encoded.columns if c != ids_col]
    rest = [f"c{i}" for i in range(len(others))]
    plain = encoded.select(*(F.col(f"`{c}`").alias(a) for c, a in zip(others, rest)), F.col(f"`{ids_col}`").alias("ids"))
    if keep:
        others, rest = [*others, ids_col], [*rest, "ids"]
    fields = "".join(f"{c} {t}, " for c, t in plain.dtypes if c in rest)
    done = plain.mapInArrow(decode_task(vocabulary.surface, rest, keep), f"{fields}text string")
    return done.select(*(F.col(a).alias(c) for c, a in zip(others, rest)), F.col("text").alias(out))


def round_trip(docs: DataFrame, text_col: str = "text", model_file: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """``docs`` without its text, with ids, n_pieces and whether decoding the ids gave the text back."""
    want, got = free_name(docs, "want"), free_name(docs, "got")
    expected = F.translate(F.coalesce(F.col(text_col), F.lit("")), MARK, " ")
    encoded = encode(docs.withColumn(want, F.xxhash64(expected)), text_col, "ids", model_file, chunk)
    ids = [c for c in encoded.columns if c not in (want, "ids")]
    back = decode(encoded, "ids", got, model_file, keep=True)
    return back.select(*ids, "ids", F.size("ids").alias("n_pieces"),
                       (F.xxhash64(got) == F.col(want)).alias("round_trip"))
