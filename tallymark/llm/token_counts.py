"""Token counts of a byte-level BPE vocabulary by finite-state transducers, without making the tokens.

Two deterministic transducers read a text. The outer one reads characters by class (letter, digit, space, apostrophe, …)
and marks where the vocabulary's pre-tokenizer starts a new word. The inner one reads the bytes of a word; each of its
transitions carries the number of tokens by which the count changes. Its states are made when a text first needs them:
a state knows, for every place where a token may still be open, the last token before that place and the count there.
BPE has exactly one token that can end a prefix, the one that is compatible with the token before it, so the count after
each byte is exact.

Texts are read side by side. They are joined and cut into chunks of equal size; the outer transducer gives each chunk a
map from the states it may start in to the state it ends in, a parallel prefix scan composes the maps, and then all
starts are known. The inner transducer starts anew at every word, so that from its first word on a chunk's map is
constant, and chunks are cut at words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.frames import kept_in_worker, slices, texts

# The pattern of the pre-tokenizer, 's|'t|'re|'ve|'m|'ll|'d| ?letters| ?digits| ?others|\s+(?!\S)|\s+
APOSTROPHE, STMD, R, V, L, E, LETTER, DIGIT, BLANK, SPACE, OTHER, RESET, UNKNOWN = range(13)
CONTRACTED = {"s": STMD, "t": STMD, "m": STMD, "d": STMD, "r": R, "v": V, "l": L, "e": E}

#: States of the outer transducer: what is being read. ``AP_R`` has read an apostrophe and an r, ``DONE`` a contraction,
#: ``BLANKS`` two or more white-space characters of which the last is a blank.
START, WORD, NUMBER, MARKS, ONE_BLANK, ONE_SPACE, BLANKS, SPACES, AP, AP_R, AP_V, AP_L, DONE = range(13)
HERE, BEFORE = 1, 2  # a word starts at this character; at the one before it

_LETTERS = (STMD, R, V, L, E, LETTER)
_PLAIN = {**dict.fromkeys(_LETTERS, WORD), DIGIT: NUMBER, APOSTROPHE: MARKS, OTHER: MARKS}

def _outer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks for each state and class."""
    first = {**_PLAIN, APOSTROPHE: AP, BLANK: ONE_BLANK, SPACE: ONE_SPACE}
    follow = np.zeros((13, 12), np.uint8)
    marks = np.full((13, 12), HERE, np.uint8)
    for state in range(13):
        for kind, to in first.items():
            follow[state, kind] = to
    for state, kinds in ((WORD, _LETTERS), (NUMBER, (DIGIT,)), (MARKS, (APOSTROPHE, OTHER))):
        for kind in kinds:
            follow[state, kind], marks[state, kind] = state, 0
    for state in (ONE_BLANK, ONE_SPACE, BLANKS, SPACES):
        for kind, to in ((BLANK, BLANKS), (SPACE, SPACES)):
            follow[state, kind], marks[state, kind] = to, 0
    for kind, to in _PLAIN.items():  # a blank goes with what follows it; of more white space only the last blank does
        follow[ONE_BLANK, kind], marks[ONE_BLANK, kind] = to, 0
        follow[BLANKS, kind], marks[BLANKS, kind] = to, BEFORE
        marks[SPACES, kind] = BEFORE | HERE
    for kind, to in ((STMD, DONE), (R, AP_R), (V, AP_V), (L, AP_L), (APOSTROPHE, MARKS), (OTHER, MARKS)):
        follow[AP, kind], marks[AP, kind] = to, 0
    for state, ends in ((AP_R, E), (AP_V, E), (AP_L, L)):
        for kind in range(12):
            marks[state, kind] |= BEFORE  # no contraction: the apostrophe stood alone
        for kind in _LETTERS:
            follow[state, kind], marks[state, kind] = WORD, BEFORE
        follow[state, ends], marks[state, ends] = DONE, 0
    follow[:, RESET] = START
    marks[:, RESET] |= HERE
    return follow, marks


FOLLOW, MARKED = _outer()
#: The states that reading a class can end in, at most three, and the place of a state among them.
ENDS = np.zeros((12, 3), np.uint8)
PLACE = np.zeros((12, 13), np.int8)
for _kind in range(12):
    _states = sorted(set(FOLLOW[:, _kind].tolist()))
    ENDS[_kind] = (_states + _states[:1] * 3)[:3]
    PLACE[_kind, _states] = range(len(_states))


class CharClasses:
    """Class of each character, asked of the vocabulary's own pre-tokenizer when the character is first seen."""

    def __init__(self, pre_tokenizer):
        self._split = lambda s: len(pre_tokenizer.pre_tokenize_str(s))
        self._of = np.full(0x110000, UNKNOWN, np.uint8)

    def _class(self, c: str) -> int:
        if c == "'":
            return APOSTROPHE
        if c == " ":
            return BLANK
        if c in CONTRACTED:
            return CONTRACTED[c]
        return next((kind for x, kind in (("a", LETTER), ("1", DIGIT), ("!", OTHER)) if self._split(x + c) == 1), SPACE)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        kinds = self._of[points]
        if (unknown := kinds == UNKNOWN).any():
            for p in np.unique(points[unknown]).tolist():
                self._of[p] = self._class(chr(p))
            kinds = self._of[points]
        return kinds


def word_starts(kinds: np.ndarray, width: int = 256) -> np.ndarray:
    """Where words start, by the outer transducer over chunks of ``width``; ``kinds`` starts with a RESET."""
    n = len(kinds)
    grid = np.full(-(-n // width) * width, RESET, np.uint8)
    grid[:n] = kinds
    grid = np.ascontiguousarray(grid.reshape(-1, width).T)  # one row for each step
    rows = grid.shape[1]
    before = np.concatenate([np.array([RESET], np.uint8), grid[-1, :-1]])

    # maps of the chunks: lanes for each state a chunk may start in, merged when they meet
    flat = FOLLOW.ravel()
    starts = ENDS[before]
    states = starts.T.astype(np.intp)
    head = min(32, width)
    for step in range(head):
        states = flat[states * 12 + grid[step]].astype(np.intp)
    one = states[0].copy()
    apart = np.flatnonzero((states != one).any(axis=0))
    others = states[:, apart]
    for step in range(head, width):
        one = flat[one * 12 + grid[step]].astype(np.intp)
        if len(apart):
            others = flat[others * 12 + grid[step][apart]].astype(np.intp)
    maps = np.repeat(one[None], 3, axis=0)
    maps[:, apart] = others
    maps = PLACE[grid[-1], maps].T.astype(np.int8)  # (chunk, place of the start) -> place of the end

    # parallel prefix scan: after the step of distance d a map covers 2 d chunks
    d = 1
    while d < rows:
        maps[d:] = np.take_along_axis(maps[d:], maps[:-d].astype(np.intp), axis=1)
        d *= 2
    state = np.full(rows, START, np.intp)
    state[1:] = ENDS[before[1:], maps[:-1, 0]]

    marks, marked = np.empty((width, rows), np.uint8), MARKED.ravel()
    for step in range(width):
        at = state * 12 + grid[step]
        marks[step] = marked[at]
        state = flat[at].astype(np.intp)
    marks = marks.T.ravel()[:n]
    found = (marks & HERE) > 0
    found[:-1] |= (marks[1:] & BEFORE) > 0
    return np.flatnonzero(found)


def _pack(node: int, last: int, count: int) -> int:
    return (node << 28) + ((last + 1) << 10) + count + 512


class CountingTransducer:
    """The inner transducer. State 0 is the start of a word.

    The table holds, for each state and byte, ``next state * 512 + change of the count + 256``; bytes get their columns
    when they are first seen. When it has ``max_states`` states, only those in use are kept.
    """

    def __init__(self, tokenizer, max_states: int = 294_912):
        self._model, self.max_states = tokenizer.model, max_states
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        self._text: dict[int, str] = {}
        self._child: dict[int, int] = {}  # node * 256 + byte -> node
        self._token: dict[int, int] = {}  # node -> token
        nodes = 1
        for text, token in tokenizer.get_vocab(with_added_tokens=False).items():
            if any(c not in back for c in text) or [t.id for t in self._model.tokenize(text)] != [token]:
                continue  # a token that no text gets
            self._text[token] = text
            node = 0
            for c in text:
                key = node * 256 + back[c]
                if key not in self._child:
                    self._child[key], nodes = nodes, nodes + 1
                node = self._child[key]
            self._token[node] = token
        self._fits: dict[tuple[int, int], bool] = {}
        self._symbol, self._bytes, self._width = np.full(256, -1, np.int16), [], 128
        self._forget()

    def _forget(self) -> None:
        #: a state: for each open place (node of the bytes since, last token before or -1, count there less count now)
        self.states: list[tuple[int, ...]] = []
        self._number: dict[tuple[int, ...], int] = {}
        self.table = np.full(1024 * self._width, -1, np.int32)
        self._intern((_pack(0, -1, 0),))

    def _columns(self, data: np.ndarray) -> np.ndarray:
        """Column of each byte."""
        for byte in np.flatnonzero(np.bincount(data, minlength=256)).tolist():
            if self._symbol[byte] < 0:
                self._symbol[byte] = len(self._bytes)
                self._bytes.append(byte)
        if len(self._bytes) > self._width:
            self._width = 256
            self._forget()
        return self._symbol[data]

    def _intern(self, state: tuple[int, ...]) -> int:
        number = self._number.get(state)
        if number is None:
            number = self._number[state] = len(self.states)
            self.states.append(state)
            if (number + 1) * self._width > len(self.table):
                more = min(len(self.table), 65_536 * self._width)
                self.table = np.concatenate([self.table, np.full(more, -1, np.int32)])
        return number

    def _fit(self, left: int, right: int) -> bool:
        if left < 0:
            return True
        if (fits := self._fits.get((left, right))) is None:
            if len(self._fits) >= 600_000:
                self._fits.clear()
            got = self._model.tokenize(self._text[left] + self._text[right])
            fits = self._fits[left, right] = len(got) == 2 and got[0].id == left and got[1].id == right
        return fits

    def _make(self, at: int) -> None:
        state, symbol = divmod(at, self._width)
        byte = self._bytes[symbol]
        opened, last, change = [], None, 0
        for packed in self.states[state]:
            child = self._child.get((packed >> 28) * 256 + byte)
            if child is None:
                continue
            opened.append((child << 28) + (packed & 0xFFFFFFF))
            token = self._token.get(child)
            if last is None and token is not None and self._fit((packed >> 10 & 0x3FFFF) - 1, token):
                last, change = token, (packed & 1023) - 512 + 1
        follow = self._intern((*(x - change for x in opened), _pack(0, last, 0)))
        self.table[at] = follow * 512 + change + 256

    def _keep(self, states: np.ndarray) -> np.ndarray:
        """Make the table anew with these states only; their new numbers."""
        used, place = np.unique(states, return_inverse=True)
        kept = [self.states[i] for i in used.tolist()]
        self._forget()
        return np.array([self._intern(s) for s in kept], np.int64)[place]

    def changes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """Change of the count at each byte. Lanes go from ``starts`` to ``ends``; ``fresh``: a word starts here."""
        out, symbols = np.zeros(len(data), np.int16), self._columns(data)
        order = np.argsort(starts - ends, kind="stable")  # longest first
        at, ends = starts[order], ends[order]
        state = np.zeros(len(at), np.int64)
        while len(at):
            state[fresh[at]] = 0
            if len(self.states) >= self.max_states:
                state = self._keep(state)
            index = state * self._width + symbols[at]
            got = self.table[index]
            if (got < 0).any():
                for i in np.unique(index[got < 0]).tolist():
                    self._make(i)
                got = self.table[index]
            out[at] = (got & 511) - 256
            state = (got >> 9).astype(np.int64)
            at = at + 1
            if at[-1] >= ends[-1]:  # the shortest lanes end first
                left = int(np.count_nonzero(at < ends))
                at, ends, state = at[:left], ends[:left], state[:left]
        return out


def byte_letters() -> dict[int, str]:
    """Byte to letter in the files of byte-level vocabularies: printable Latin-1 as it is, others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TokenCounter:
    """Token counts of texts, as the library gives them without added special tokens."""

    def __init__(self, path: str, lane_bytes: int = 512):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        special = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, special))) if special else None
        self._classes, self._inner = CharClasses(tokenizer.pre_tokenizer), CountingTransducer(tokenizer)
        self._lane = lane_bytes

    def __call__(self, texts: list[str]) -> np.ndarray:
        # special strings are tokens of their own, also in the middle of a word: the text is read in parts between them
        parts = [self._special.split(t) if self._special else [t] for t in texts]
        n_parts = np.array([len(p) for p in parts], np.int64)
        pieces = [x for p in parts for x in p]
        joined = "".join(pieces)
        if not joined:
            return n_parts - 1
        kinds = self._classes(np.frombuffer(joined.encode("utf-32-le"), np.uint32))
        begins = np.cumsum([0, *map(len, pieces)])[:-1]
        marked = np.insert(kinds, begins, RESET)
        words = word_starts(marked)
        words = words[marked[words] != RESET]
        words -= np.searchsorted(begins + np.arange(len(begins)), words)

        data = np.frombuffer(joined.encode(), np.uint8)
        words = np.flatnonzero((data & 0xC0) != 0x80)[words]
        fresh = np.zeros(len(data), bool)
        fresh[words] = True
        starts = words[np.concatenate([[True], words[1:] // self._lane != words[:-1] // self._lane])]
        changes = self._inner.changes(data, starts, np.concatenate([starts[1:], [len(data)]]), fresh)
        total = np.concatenate([[0], np.cumsum(changes, dtype=np.int64)])
        ends = np.cumsum([len(x.encode()) for x in pieces])[np.cumsum(n_parts) - 1]
        return np.diff(total[np.concatenate([[0], ends])]) + n_parts - 1


def counter_for(path: str) -> TokenCounter:
    """The counter of this Python worker: later tasks find the states already made."""
    return kept_in_worker(("counter", path), lambda: TokenCounter(path))


def count_tokens(docs: DataFrame, vocabulary: str, *, text: str = "text", name: str = "n_tokens", keep_text: bool = True) -> DataFrame:
    """``docs`` with the number of tokens of ``text`` by the byte-level BPE ``vocabulary`` (path of its JSON file).

    Counts are those of the library, without begin, end or other added tokens; the strings of special tokens inside a
    text count as one token each. A null or empty text has none; very long texts are read whole, in memory bounded by a
    batch of about 4 MB or one text. Other columns, whatever their names, stay; a column called ``name`` is replaced.
    The text itself, which need not go to Python and back, stays only with ``keep_text``.
    """
    kept = [c for c in docs.columns if c.lower() != name.lower() and (keep_text or c != text)]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(f"`{text}`").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(vocabulary)
        for batch in slices(batches, "text"):
            n = pa.array(counter(texts(batch, "text")), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), n], ["row", "n"])

    counted = rows.mapInArrow(count, rows.select("row", F.lit(0).cast("long").alias("n")).schema)
    return counted.select(*(F.col("row").getField(c).alias(c) for c in kept), F.col("n").alias(name))
