"""Packing token ids into sequences of bounded length by order-preserving dynamic programming.

The tokens of the documents of a block follow one another in the order of the rows. A block is cut into windows of at
most ``length`` tokens. Cuts may lie where a document ends (free), where a sentence ends (``sentence_penalty`` tokens) or,
in sentences longer than ``hard_every`` tokens, at every ``hard_every``-th token (``hard_penalty``). A window costs its
padding: what is missing to ``length``, or nothing if it holds a power of two of tokens (from ``length / 4`` on, so that
there are no tiny sequences). The least total
is found for every cut ``j``:

    best[j] = penalty[j] + min over cuts i < j of best[i] + padding(at[j] - at[i])

For the padded windows that is ``length - at[j] + min(best[i] + at[i])`` over a sliding range of ``i``, whose minimum a
monotone queue keeps; the windows that need no padding are looked up at the places where they start.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.frames import kept_in_worker, slices, texts
from tallymark.llm.token_counts import byte_letters

PIECES = (
    "start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, padded bigint"
)


class WordIds:
    """Token ids of a vocabulary that splits texts into words before anything else, one word at a time.

    A word always gets the same ids, so those of frequent words are looked up, and new words go straight to the
    vocabulary's merges. Texts with characters whose lower case, normal form or class may depend on more than the
    character (all but Latin letters and common marks), or with special strings, go to the library whole.
    """

    # The pattern by which the vocabulary splits lower-case texts, its letters and digits up to U+017E.
    _LETTERS = "a-zªµºß-öø-ž"
    PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9²³¹¼-¾]|[^\sa-z0-9²³¹¼-¾{_LETTERS}]+"
    PLAIN = r"[\x09-\x0d\x20-\x7e\xa1-\xac\xae-įĲ-ž‐-‧‰-⁞₠-₿]*"

    def __init__(self, path: str, max_words: int = 300_000):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._merges = self._library.model.tokenize
        self._words, self._plain = re.compile(self.PATTERN).findall, re.compile(self.PLAIN).fullmatch
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._letters = {b: ord(c) for b, c in byte_letters().items()}
        self._ids: dict[str, bytes] = {}
        self._max_words = max_words
        vocabulary = self._library.get_vocab(with_added_tokens=True)
        self.ends_sentence = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends_sentence[number] = bool(re.search(r"[.!?]['\")\]]*</w>$", token))

    def whole(self, text: str) -> bytes:
        return np.array(self._library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(self._letters)
        return np.array([t.id for t in self._merges(letters)], "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not self._plain(text) or any(s in text for s in self._special):
            return self.whole(text)
        words, known = self._words(text.lower()), self._ids
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            if len(known) > self._max_words:
                known.clear()
            for word in words:
                if word not in known:
                    known[word] = self._word(word)
            return b"".join(map(known.__getitem__, words))


def word_ids(path: str) -> WordIds:
    """The table of words of this Python worker."""
    return kept_in_worker(("words", path), lambda: WordIds(path))


def cut_places(
    ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray, sentence_penalty: int, hard_penalty: int, hard_every: int
) -> tuple[np.ndarray, np.ndarray]:
    """Where a block may be cut (from 0 to its end), and the penalty of each place."""
    penalty = np.full(len(ids) + 1, -1, np.int32)
    penalty[1:][ends_sentence[ids]] = sentence_penalty
    penalty[0] = 0
    penalty[doc_ends] = 0
    at = np.flatnonzero(penalty >= 0)
    gaps = np.diff(at)
    for i in np.flatnonzero(gaps > hard_every).tolist():
        penalty[at[i] + hard_every : at[i + 1] : hard_every] = hard_penalty
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


def best_windows(at: list[int], penalty: list[int], length: int) -> list[int]:
    """Indexes of the cuts, first and last included, of the windows with the least padding and penalties."""
    n = len(at)
    powers = [1 << p for p in range(length.bit_length()) if length <= 4 << p and 1 << p <= length]
    place = {a: i for i, a in enumerate(at)}
    best, back = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (best + at, index), increasing
    for j in range(1, n):
        here = at[j]
        while at[queue[0][1]] < here - length:
            queue.popleft()
        low, source = queue[0]
        low += length - here
        for power in powers:
            i = place.get(here - power)
            if i is not None and best[i] < low:
                low, source = best[i], i
        best[j], back[j] = low + penalty[j], source
        entry = best[j] + here
        while queue and queue[-1][0] >= entry:
            queue.pop()
        queue.append((entry, j))
    cuts = [n - 1]
    while cuts[-1] > 0:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def pack(
    docs: DataFrame,
    vocabulary: str,
    *,
    length: int = 4096,
    end_id: int = 2,
    text: str = "text",
    sentence_penalty: int = 4,
    hard_penalty: int = 64,
    hard_every: int = 256,
    block_tokens: int = 1_000_000,
    with_ids: bool = True,
    keep_text: bool = False,
) -> DataFrame:
    """``docs`` packed into sequences of at most ``length`` tokens: one row per piece of a document.

    The tokens of a document are its ids by ``vocabulary`` and ``end_id``, so a null or empty text has one. The rows of a
    partition are packed in their order, in blocks of about ``block_tokens`` (a longer document is a block of its own), so
    nothing is shuffled, memory is bounded by a block, and a task that is run again gives the same sequences. Columns
    added to those of ``docs``: ``piece``, a struct of ``start`` (ids of the document before the piece), ``length``,
    ``ids`` (null without ``with_ids``), ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers), ``doc_tokens``, ``sequence_id``,
    ``offset`` (in the sequence) and ``padded`` (length of the sequence after padding). A column of that name is replaced;
    the text stays only with ``keep_text``.
    """
    kept = [c for c in docs.columns if c.lower() != "piece" and (keep_text or c != text)]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(f"`{text}`").alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def packed(held: list[tuple[pa.RecordBatch, int]], ids: list[bytes], first: int, ends_sentence: np.ndarray):
        block = np.frombuffer(b"".join(ids), "<u4")
        doc_ends = np.cumsum([len(x) // 4 for x in ids])
        at, penalty = cut_places(block, doc_ends, ends_sentence, sentence_penalty, hard_penalty, hard_every)
        chosen = at[best_windows(at.tolist(), penalty.tolist(), length)]
        cuts = np.union1d(chosen, np.concatenate([[0], doc_ends]))
        begin, size = cuts[:-1], np.diff(cuts)
        doc = np.searchsorted(doc_ends, begin, side="right")
        window = np.searchsorted(chosen, begin, side="right") - 1
        doc_sizes = np.diff(np.concatenate([[0], doc_ends]))
        filled = np.diff(chosen)[window]
        values = [block[b : b + s].tobytes() for b, s in zip(begin.tolist(), size.tolist(), strict=True)]
        whole = pa.Table.from_batches([b for b, _ in held]).combine_chunks()
        columns = [
            begin - (doc_ends - doc_sizes)[doc],
            size,
            pa.array(values if with_ids else [None] * len(values), pa.binary()),
            np.array([zlib.crc32(v) for v in values], np.int64),
            doc_sizes[doc],
            first + window,
            begin - chosen[window],
            np.where(filled & (filled - 1) == 0, filled, length),
        ]
        columns = [c if isinstance(c, pa.Array) else pa.array(c.astype(np.int64)) for c in columns]
        return whole.column("row").take(pa.array(doc)), columns, len(chosen) - 1

    names = [field.split()[0] for field in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        words = word_ids(vocabulary)
        held, ids, total = [], [], 0

        def flush():
            nonlocal held, ids, total, first
            row, columns, n = packed(held, ids, first, words.ends_sentence)
            first += n
            piece = pa.StructArray.from_arrays(columns, names)
            for chunk in pa.Table.from_arrays([row, piece], ["row", "piece"]).to_batches(max_chunksize=4096):
                yield chunk
            held, ids, total = [], [], 0

        for batch in slices(batches, "text", 1_000_000):
            new = [words(t) + end for t in texts(batch, "text")]
            held.append((batch.select(["row"]), len(new)))
            ids += new
            total += sum(map(len, new)) // 4
            if total >= block_tokens:
                yield from flush()
        if ids:
            yield from flush()

    piece = F.lit(None).cast(f"struct<{', '.join(f.replace(' ', ': ') for f in PIECES.split(', '))}>")
    out = rows.mapInArrow(run, rows.select("row", piece.alias("piece")).schema)
    return out.select(*(F.col("row").getField(c).alias(c) for c in kept), "piece")
