"""SentencePiece encoding and decoding by a max-plus parallel scan over chunks of a text."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from ebbline.llm.tables import give_back_memory, row_key, whole_text
from ebbline.workspace import stage

CHUNK = 1 << 16  # characters
SPACE = "▁"
NEVER = float("-inf")
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_IDS_AT_ONCE = 500_000
_ROWS_AT_ONCE = 500
_BPE, _NORMAL, _UNKNOWN, _BYTE = 2, 1, 2, 6  # fixed values of the model file
_MEMO_WORDS = 150_000
_MEMO_PAIRS = 300_000
_MEMO_ENDS = 100_000
_SHORT_END = 12  # characters
_SHORT_WORD = 48  # characters: up to here merging, which is quadratic, is quicker than the search for the stable path
_LONG = 5
_SHORT = (4, 3, 2, 1)

State = tuple[int, int]  # a piece that covers the character before a cut: its begin and end, from the cut
Matrix = dict[State | None, dict[State | None, float]]  # None: before the text's first piece, after its last


class Memory(dict):
    """Remembers what was met since it was last full and what was met in the time before that."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.older = most, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is not None:
            self.add(key, found)
        return found

    def add(self, key, value) -> None:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value


class Vocabulary:
    """The pieces of a model file and what a path through a text may do.

    A path is a sequence of pieces. For a unigram model its score is the sum of the pieces' scores. For a BPE
    model, merging ends in the one path whose neighbours are all stable, that is, encoding the two of them would not
    merge anything across their border: a step between stable neighbours has score 0, any other minus infinity.
    """

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.bpe = proto.trainer_spec.model_type == _BPE
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("the model changes texts before encoding; only models that keep them are handled")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.pieces = [p.piece for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == _NORMAL}
        self.byte_of = {i: int(p.piece[1:-1], 16) for i, p in enumerate(proto.pieces) if p.type == _BYTE}
        self.byte_ids = {b: i for i, b in self.byte_of.items()}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == _UNKNOWN)
        self.longest = max(map(len, self.ids), default=1)
        self.lost = min(self.score.values(), default=0.0) - 10.0  # unigram score of a character without a piece
        # No piece goes on over a space behind another sign; such places part words that are encoded alone.
        self.parts_words = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        lengths: dict[str, set[int]] = {}  # of the pieces that begin with these signs
        for piece in self.ids:
            if len(piece) >= _LONG:
                lengths.setdefault(piece[:_LONG], {*_SHORT}).add(len(piece))
        self._lengths = {begin: sorted(found, reverse=True) for begin, found in lengths.items()}
        self._words = Memory(_MEMO_WORDS)  # ids of a word, by the word without its space
        self._ends: dict[tuple[int, str], tuple[int, ...]] = {}  # ids of a word's last characters behind a piece
        self._pairs = Memory(_MEMO_PAIRS)  # whether two pieces, by their ids in one number, are stable
        self._splits: dict[str, tuple[str, str] | None] = {}
        if self.bpe:  # pieces that merging never builds are no steps of any path
            self.ids = {p: i for p, i in self.ids.items() if len(p) == 1 or self._split(p)}
            # Pieces with a merge that shares its score with others: scores don't tell the order of their merges.
            times = Counter(self.score[p] for p in self.ids if len(p) > 1)
            self._untimed = set()
            for piece in sorted(self.ids, key=len):
                if len(piece) > 1 and (times[self.score[piece]] > 1 or not self._untimed.isdisjoint(self._split(piece))):
                    self._untimed.add(piece)

    def _merged(self, symbols: list[str], stop_at: str | None = None) -> list[str]:
        """Merge as the model does: the best score first, the leftmost of equal ones. Ends before `stop_at` is made."""
        while len(symbols) > 1:
            best = max(
                ((self.score[a + b], -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in self.score),
                default=None,
            )
            if best is None:
                return symbols
            i = -best[1]
            if symbols[i] + symbols[i + 1] == stop_at and len(symbols) == 2:
                return symbols
            symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2:]]
        return symbols

    def _split(self, piece: str) -> tuple[str, str] | None:
        """The last merge that makes a piece."""
        if piece not in self._splits:
            parts = self._merged(list(piece), piece) if len(piece) > 1 else []
            self._splits[piece] = (parts[0], parts[1]) if len(parts) == 2 and "".join(parts) in self.score else None
        return self._splits[piece]

    def _made(self, piece: str) -> float:
        """When a piece is merged (scores fall with time); characters are there from the start."""
        return -self.score[piece] if len(piece) > 1 else NEVER

    def stable(self, left: str, right: str) -> bool:
        """Whether two pieces stay apart: undo the merges beside their border, the latest first, and see whether one
        across it would have come before (of equal ones the left one comes first)."""
        pair = self.ids[left] << 32 | self.ids[right]
        known = self._pairs[pair]
        if known is None:
            if left in self._untimed or right in self._untimed:
                known = self._merged([*left, *right]) == [left, right]
            else:
                known = self._undone(left, right)
            self._pairs.add(pair, known)
        return known

    def _undone(self, left: str, right: str) -> bool:
        before = float("inf")
        while True:
            across = self.score.get(left + right)
            if across is not None and -across < before:
                return False
            on_left, on_right = self._made(left), self._made(right)
            if on_left == on_right == NEVER:
                return True
            if on_left > on_right:
                before, left = on_left, self._split(left)[1]
            else:
                before, right = on_right + 0.5, self._split(right)[0]

    def step(self, before: str | None, piece: str) -> float:
        """The score of going on with `piece`."""
        if not self.bpe:
            return self.score.get(piece, self.lost)
        if before is None or before not in self.ids or piece not in self.ids:
            return 0.0
        return 0.0 if self.stable(before, piece) else NEVER

    def candidates(self, text: str, begin: int) -> Iterator[int]:
        """Ends of the pieces that begin at a place; a character without a piece is a piece of its own."""
        ids = self.ids
        found = text[begin:begin + 1] in ids
        if not found:
            yield begin + 1
        for end in range(begin + (1 if found else 2), min(begin + self.longest, len(text)) + 1):
            if text[begin:end] in ids:
                yield end

    def parted(self, text: str, at: int) -> bool:
        return self.parts_words and text[at] == SPACE and text[at - 1] != SPACE

    def ids_of(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        if self.byte_ids:
            return [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
        return [self.unknown]

    def whole_words(self, text: str) -> tuple[list[int], float]:
        """Ids and score of a text that is cut before and behind: its words are encoded one by one."""
        ids: list[int] = []
        if self.bpe and self.parts_words and text[:1] == SPACE and SPACE + SPACE not in text:
            known, add, extend = self._words.get, self.word, ids.extend
            for bare in text[1:].split(SPACE):
                extend(known(bare) or add(SPACE + bare, bare))
            return ids, 0.0
        if self.bpe:
            for word in _WORDS.findall(text):
                ids.extend(self.word(word, word[1:] if word[0] == SPACE else f"{SPACE} {word}"))
            return ids, 0.0
        total = 0.0
        for word in _WORDS.findall(text):
            walk = Walk(self, word, 0, None, len(word))
            ids.extend(i for a, b in walk.path(len(word)) for i in self.ids_of(word[a:b]))
            total += walk.best[len(word)][0]
        return ids, total

    def forget(self) -> None:
        """Drop the remembered words: workers live on, and the next stage needs their memory."""
        self._words.clear()
        self._words.older = {}
        give_back_memory()

    def word(self, word: str, name: str) -> tuple[int, ...]:
        """Ids of a word that is encoded alone (BPE); `name` is what it is remembered by."""
        found = self._words[name]
        if found is None:
            found = self._merged_ids(word) if len(word) <= _SHORT_WORD else self._stable_ids(word)
            self._words.add(name, found)
        return found

    def _merged_ids(self, word: str) -> tuple[int, ...]:
        """Ids of a short word by merging it as the model does: the best score first, the leftmost of equal ones."""
        score = self.score.get
        symbols = list(word)
        scores = [score(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while scores and (best := max(scores)) > NEVER:
            i = scores.index(best)
            symbols[i] += symbols.pop(i + 1)
            del scores[i]
            if i:
                scores[i - 1] = score(symbols[i - 1] + symbols[i], NEVER)
            if i < len(scores):
                scores[i] = score(symbols[i] + symbols[i + 1], NEVER)
        ids = self.ids
        try:
            return tuple([ids[s] for s in symbols])
        except KeyError:
            return tuple([i for s in symbols for i in self.ids_of(s)])

    def _stable_ids(self, word: str) -> tuple[int, ...]:
        """The only path of score 0 through a word: depth first, long pieces first. A place is reached by one stable
        path at most, so one that leads nowhere is never tried again. How a word ends depends on what is left of
        it and the piece before only, so short ends are remembered."""
        id_of, pair, lengths, end_of = self.ids.get, self._pairs.get, self._lengths.get, self._ends.get
        size, begin, before, known_end = len(word), 0, -1, None
        path: list[tuple[int, int]] = []  # begin and id, -1 for a character without a piece
        nowhere: set[int] = set()
        while begin < size:
            left = size - begin
            if begin and left <= _SHORT_END:
                known_end = end_of((before, word[begin:]))
                if known_end is not None:
                    break
            for length in lengths(word[begin:begin + _LONG], _SHORT):
                if length > left:
                    continue
                piece = id_of(word[begin:begin + length], -1)
                if piece < 0:
                    if length > 1:
                        continue
                elif before >= 0:
                    stable = pair(before << 32 | piece)
                    if not stable and (stable is False or not self.stable(self.pieces[before], word[begin:begin + length])):
                        continue
                if nowhere and begin + length in nowhere:
                    continue
                path.append((begin, piece))
                begin, before = begin + length, piece
                break
            else:
                nowhere.add(begin)
                begin, _ = path.pop()
                before = path[-1][1] if path else -1
        found = known_end or ()
        for at, piece in reversed(path):
            if 0 < size - begin <= _SHORT_END and known_end is not found:
                if len(self._ends) >= _MEMO_ENDS:
                    self._ends.clear()
                self._ends[piece, word[begin:]] = found
            found = ((piece,) if piece >= 0 else tuple(self.ids_of(word[at:begin]))) + found
            begin = at
        return found


def vocabulary_of(model: Broadcast) -> Vocabulary:
    """One vocabulary a worker process, with the words it remembers, kept beside the bytes it was made from."""
    if not hasattr(model, "vocabulary"):
        model.vocabulary = Vocabulary(model.value)
    return model.vocabulary


_sent: dict[tuple[str, str], Broadcast] = {}  # by application and digest of the model file


def shared_model(spark: SparkSession, model: bytes) -> Broadcast:
    """One broadcast of a model file a session, so that a worker process holds one vocabulary for all its tasks."""
    key = spark.sparkContext.applicationId, hashlib.sha256(model).hexdigest()
    if key not in _sent:
        _sent[key] = spark.sparkContext.broadcast(model)  # texts of any size meet the same one
    return _sent[key]


class Walk:
    """Best paths from one place and piece to all places up to `until` (pieces may end behind it).

    One survivor a place is enough: a unigram step doesn't ask what came before, and of two BPE paths to
    one place only one is stable. `others` are walks over the same text: once this one has agreed with one of them, up
    to a constant, over as many places as the longest piece has characters, it goes on like that one.
    """

    def __init__(self, vocabulary: Vocabulary, text: str, begin: int, before: str | None, until: int, others=()):
        self.text, self.begin, self.joined, self.joined_at, self.gain = text, begin, None, until, 0.0
        best: dict[int, tuple[float, int]] = {begin: (0.0, -1)}
        self.best, self.exits = best, {}
        alike, gaps = [0] * len(others), [None] * len(others)
        for place in range(begin, until):
            mine = best.get(place)
            for k, other in enumerate(others):
                theirs = other.lookup(place)
                if mine is None or theirs is None:
                    same = mine is theirs
                else:
                    gap = mine[0] - theirs[0]
                    same = mine[1] == theirs[1] and gaps[k] in (None, gap)
                    gaps[k] = gap
                alike[k], gaps[k] = (alike[k] + 1, gaps[k]) if same else (0, None)
                if alike[k] > vocabulary.longest and gaps[k] is not None:
                    self.joined, self.joined_at, self.gain = other, place, gaps[k]
                    return
            if mine is None:
                continue
            score, origin = mine
            last = before if origin < 0 else text[origin:place]
            for end in vocabulary.candidates(text, place):
                total = score + vocabulary.step(last, text[place:end])
                if total > best.get(end, (NEVER, 0))[0]:
                    best[end] = (total, place)
                if end >= until and total > NEVER:
                    self.exits[(place, end)] = total

    def lookup(self, place: int) -> tuple[float, int] | None:
        if self.joined and place >= self.joined_at:
            found = self.joined.lookup(place)
            return found and (found[0] + self.gain, found[1])
        return self.best.get(place)

    def all_exits(self) -> dict[State, float]:
        if not self.joined:
            return self.exits
        return {s: v + self.gain for s, v in self.joined.all_exits().items()}

    def path(self, end: int) -> list[State]:
        """The pieces up to `end`, without the piece the walk came from."""
        pieces = []
        while end > self.begin:
            begin = self.lookup(end)[1]
            pieces.append((begin, end))
            end = begin
        return pieces[::-1]


class Chunk:
    """The characters from `begin` to `end` of a text of `size`; `text` holds the longest piece to either side, too."""

    def __init__(self, vocabulary: Vocabulary, text: str, at: int, begin: int, end: int, size: int):
        self.vocabulary, self.text = vocabulary, text
        self.begin, self.end, self.last = begin - at, end - at, end == size
        self.cut_from = self.cut_to = None  # places that part words: what lies between doesn't depend on the states
        if vocabulary.parts_words:
            if begin == 0:
                self.cut_from = self.begin
            else:
                self.cut_from = self._parting(self.begin + vocabulary.longest, self.end)
            if self.cut_from is not None:
                self.cut_to = self.end if self.last else self._parting(self.end - 1, self.cut_from, -1)
                if self.cut_to is None:
                    self.cut_to = self.cut_from

    def _parting(self, start: int, stop: int, step: int = 1) -> int | None:
        return next((i for i in range(start, stop, step) if self.vocabulary.parted(self.text, i)), None)

    def _entries(self) -> list[State | None]:
        if self.begin == 0:
            return [None]
        found, text, v = [], self.text, self.vocabulary
        for a in range(max(0, self.begin - v.longest), self.begin):
            found += [(a - self.begin, e - self.begin) for e in v.candidates(text, a) if e >= self.begin]
        return found

    def _walks(self, entries: list[State | None], until: int) -> dict[State | None, Walk]:
        walks: dict[State | None, Walk] = {}
        for state in entries:
            begin = self.begin if state is None else self.begin + state[1]
            before = None if state is None else self.text[self.begin + state[0]:begin]
            walks[state] = Walk(self.vocabulary, self.text, begin, before, until, list(walks.values()))
        return walks

    def _leaving(self, exits: dict[State, float]) -> dict[State | None, float]:
        if self.last:
            return {None: exits[s] for s in exits if s[1] == self.end}
        return {(a - self.end, b - self.end): score for (a, b), score in exits.items()}

    def matrix(self) -> Matrix:
        """Best scores from every state at the begin to every state at the end; what cannot be is left out."""
        if self.cut_from is None:
            out: Matrix = {}
            for state, walk in self._walks(self._entries(), self.end).items():
                if state is not None and self.begin + state[1] >= self.end:  # one piece over the whole chunk
                    out[state] = self._leaving({(self.begin + state[0], self.begin + state[1]): 0.0})
                else:
                    best: dict[State | None, float] = {}
                    for (a, b), score in sorted(walk.all_exits().items()):
                        for leaving, total in self._leaving({(a, b): score}).items():
                            best[leaving] = max(total, best.get(leaving, NEVER))
                    out[state] = best
            return out
        inner = self.vocabulary.whole_words(self.text[self.cut_from:self.cut_to])[1]
        if self.last:
            right: dict[State | None, float] = {None: 0.0}
        else:
            right = self._leaving(Walk(self.vocabulary, self.text, self.cut_to, None, self.end).all_exits())
        left = {}
        for state, walk in self._walks(self._entries(), self.cut_from).items():
            reached = (0.0, -1) if state is None else walk.lookup(self.cut_from)
            left[state] = reached[0] if reached else NEVER
        return {s: {t: a + inner + b for t, b in right.items()} for s, a in left.items() if a > NEVER}

    def trace(self, entry: State | None, leaving: State | None) -> list[int]:
        """The ids of the pieces after the entry's, up to the one that leaves the chunk, on the best path between."""
        v, text, ids = self.vocabulary, self.text, []

        def along(walk: Walk, end: int) -> None:
            for a, b in walk.path(end):
                ids.extend(v.ids_of(text[a:b]))

        if self.cut_from is None:
            if entry is not None and self.begin + entry[1] >= self.end:
                return []
            along_from = self._walks([entry], self.end)[entry]
        else:
            if entry is not None:
                along(self._walks([entry], self.cut_from)[entry], self.cut_from)
            ids.extend(v.whole_words(text[self.cut_from:self.cut_to])[0])
            if self.last:
                return ids
            along_from = Walk(v, text, self.cut_to, None, self.end)
        if leaving is None:
            along(along_from, self.end)
        else:
            along(along_from, self.end + leaving[0])
            ids.extend(v.ids_of(text[self.end + leaving[0]:self.end + leaving[1]]))
        return ids


def combine(left: Matrix, right: Matrix) -> Matrix:
    """The max-plus product: best scores over both chunks. It is associative."""
    out: Matrix = {}
    for state, row in left.items():
        best: dict[State | None, float] = {}
        for middle, a in row.items():
            for leaving, b in right.get(middle, {}).items():
                best[leaving] = max(a + b, best.get(leaving, NEVER))
        out[state] = best
    return out


def states_at_cuts(matrices: list[Matrix]) -> list[tuple[State | None, State | None]]:
    """Entry and exit of every chunk on the best path of the whole text."""
    upto = list(accumulate(matrices, combine))
    found, leaving = [], None
    for k in range(len(matrices) - 1, -1, -1):
        entry = None
        if k:
            scores = {s: upto[k - 1][None][s] + row[leaving] for s, row in matrices[k].items()
                      if leaving in row and s in upto[k - 1][None]}
            entry = max(sorted(scores), key=scores.get)
        found.append((entry, leaving))
        leaving = entry
    return found[::-1]


def _spaced(vocabulary: Vocabulary, text: str) -> str:
    return vocabulary.prefix + text.replace(" ", SPACE) if text else ""


def _lists(found: list[array]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
    flat = np.concatenate([np.frombuffer(x, dtype=np.int32) for x in found] or [np.empty(0, np.int32)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _encode_short(model):
    """Texts of one chunk: no cuts, so no states."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(model)
        for batch in batches:
            begin, held, size = 0, [], 0
            for i, text in enumerate(batch.column("text")):
                spaced = _spaced(vocabulary, text.as_py())
                held.append(array("i", Chunk(vocabulary, spaced, 0, 0, len(spaced), len(spaced)).trace(None, None)))
                size += len(held[-1])
                if size >= _IDS_AT_ONCE or i + 1 == batch.num_rows:
                    ids = batch.column("doc_id").slice(begin, len(held))
                    yield pa.RecordBatch.from_arrays([ids, _lists(held)], ["doc_id", "ids"])
                    begin, held, size = i + 1, [], 0
        vocabulary.forget()

    return encode


_CHUNKS = "id long, mark long, number long, at long, begin long, end long, size long, text string"


def _cut(model, chunk: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(model)
        for batch in batches:
            for row in batch.to_pylist():
                text = _spaced(vocabulary, row["text"])
                for number, begin in enumerate(range(0, len(text), chunk)):
                    at, end = max(0, begin - vocabulary.longest - 1), min(begin + chunk, len(text))
                    part = text[at:end + vocabulary.longest + 1]
                    values = [row["id"], row["mark"], number, at, begin, end, len(text), part]
                    yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], [c.split()[0] for c in _CHUNKS.split(", ")])

    return cut


def _chunk(vocabulary: Vocabulary, row: dict) -> Chunk:
    return Chunk(vocabulary, row["text"], row["at"], row["begin"], row["end"], row["size"])


def _matrices(model):
    names = ["id", "mark", "number", "entries", "leavings", "scores"]

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(model)
        for batch in batches:
            for row in batch.to_pylist():
                cells = [
                    ([*(s or ())], [*(t or ())], score)
                    for s, line in _chunk(vocabulary, row).matrix().items() for t, score in line.items()
                ]
                values = [row["id"], row["mark"], row["number"], *([c[i] for c in cells] for i in range(3))]
                kinds = [pa.int64()] * 3 + [pa.list_(pa.list_(pa.int64()))] * 2 + [pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    return matrices


def _scan(rows: pd.DataFrame) -> pd.DataFrame:
    """The states of one document; its chunks' matrices are small and bounded by the document."""
    rows = rows.drop_duplicates("number").sort_values("number")
    matrices = []
    for entries, leavings, scores in zip(rows["entries"], rows["leavings"], rows["scores"]):
        matrix: Matrix = {}
        for s, t, score in zip(entries, leavings, scores):
            matrix.setdefault(tuple(map(int, s)) or None, {})[tuple(map(int, t)) or None] = float(score)
        matrices.append(matrix)
    states = states_at_cuts(matrices)
    return pd.DataFrame({
        "id": rows["id"].to_numpy(), "mark": rows["mark"].to_numpy(), "number": rows["number"].to_numpy(),
        "entry": [list(s or ()) for s, _ in states], "leaving": [list(t or ()) for _, t in states],
    })


def _traced(model):
    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(model)
        for batch in batches:
            for row in batch.to_pylist():
                ids = _chunk(vocabulary, row).trace(tuple(row["entry"]) or None, tuple(row["leaving"]) or None)
                columns = [pa.array([row[c]]) for c in ("id", "mark", "number")]
                yield pa.RecordBatch.from_arrays([*columns, _lists([array("i", ids)])], ["id", "mark", "number", "ids"])

    return traced


def encode(docs: DataFrame, model: bytes, chunk: int = CHUNK) -> DataFrame:
    """doc_id, ids: the piece ids of every text, equal to the model's own encoding; one row per row of `docs`.

    Texts are cut every `chunk` characters, wherever that is. A cut has a few states, the pieces that may lie across
    it. Each chunk gives the best score from every state at its begin to every state at its end; these matrices are
    combined by the max-plus product, which gives the states on the best path; then every chunk is traced back on its
    own. Texts without a cut have one chunk, which is traced at once and not shuffled.

    Null and empty texts have no ids. Null ids and repeated rows are encoded like any other. An empty table
    gives no rows. Other columns are not read. Characters without a piece become their bytes (or the unknown id).
    """
    shared = shared_model(docs.sparkSession, model)
    short, long = _by_length(docs, chunk)
    short = short.mapInArrow(_encode_short(shared), "doc_id long, ids array<int>")
    return short.unionByName(_encode_long(long, shared, chunk))


def round_trip(docs: DataFrame, model: bytes, chunk: int = CHUNK) -> DataFrame:
    """doc_id, ids, text: what `decode` makes of `encode`; texts without a cut go both ways in one pass."""
    shared = shared_model(docs.sparkSession, model)
    short, long = _by_length(docs, chunk)
    there, back = _encode_short(shared), _decode(shared)
    short = short.mapInArrow(lambda batches: back(there(batches)), _DECODED)
    return short.unionByName(decode(_encode_long(long, shared, chunk), model))


def _by_length(docs: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
    """Texts of one chunk and those of several."""
    texts = docs.select("doc_id", *row_key(), whole_text().alias("text"))
    cut_at = chunk - 1  # a model may put one space before the text
    return texts.filter(F.length("text") <= cut_at).select("doc_id", "text"), texts.filter(F.length("text") > cut_at)


def _encode_long(long: DataFrame, shared: Broadcast, chunk: int) -> DataFrame:
    chunks = long.select("id", "mark", "text").mapInArrow(_cut(shared, chunk), _CHUNKS)
    chunks = stage(chunks, "pieces-chunks")
    states = "array<array<long>>"
    matrices = chunks.mapInArrow(
        _matrices(shared),
        f"id long, mark long, number long, entries {states}, leavings {states}, scores array<double>",
    )
    cuts = matrices.groupBy("id", "mark").applyInPandas(
        _scan, "id long, mark long, number long, entry array<long>, leaving array<long>"
    )
    key = ["id", "mark", "number"]
    traced = chunks.join(cuts, key).mapInArrow(_traced(shared), "id long, mark long, number long, ids array<int>")
    parts = F.array_sort(F.collect_set(F.struct("number", "ids")))
    whole = traced.groupBy("id", "mark").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
    return long.select("doc_id", "id", "mark").join(whole, ["id", "mark"]).select("doc_id", "ids")


def decoded(vocabulary: Vocabulary, ids: list[int], has_bytes: bool = True) -> str:
    """The text of a sequence of ids; bytes that are no UTF-8 become U+FFFD, spaces come back from their sign."""
    pieces, byte_of = vocabulary.pieces, vocabulary.byte_of
    if not has_bytes:
        text = "".join(map(pieces.__getitem__, ids))
    else:
        parts = [bytes([byte_of[i]]) if i in byte_of else pieces[i].encode("utf-8", "surrogatepass") for i in ids]
        text = b"".join(parts).decode("utf-8", "replace")
    return text.removeprefix(vocabulary.prefix).replace(SPACE, " ")


_DECODED = "doc_id long, ids array<int>, text string"


def _decode(shared: Broadcast):
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(shared)
        is_byte = np.zeros(len(vocabulary.pieces), dtype=bool)
        is_byte[list(vocabulary.byte_of)] = True
        for batch in batches:
            for begin in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(begin, _ROWS_AT_ONCE)
                rows = [np.asarray(x.values) if x.is_valid else np.empty(0, np.int32) for x in part.column("ids")]
                found = [decoded(vocabulary, row.tolist(), bool(is_byte[row].any())) for row in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(found, pa.string())], ["doc_id", "ids", "text"]
                )

    return texts


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """`encoded` (doc_id, ids) with the column text. Null or empty ids: the empty text."""
    shared = shared_model(encoded.sparkSession, model)
    return encoded.select("doc_id", "ids").mapInArrow(_decode(shared), _DECODED)
