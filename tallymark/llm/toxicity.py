"""Toxicity of texts by subword-bag embeddings and a linear softmax, trained together.

A word is the bag of its character n-grams, hashed to buckets; its vector is their mean, so a misspelling that was never
seen shares most of its n-grams with the word it comes from. Vectors are averaged over windows of a few words, a linear
softmax over two classes scores each window, and a text scores as its worst window does: a few toxic words count the same
in a short and in a very long text. Training moves embeddings and softmax together, in numpy, on a bounded sample of
labelled texts: first from the mean of all words of a text, which finds the words that matter, then from its worst window.
Scoring reads every text whole.

Since the softmax is linear, the difference of its two logits is a sum over words of one number each, which is looked up.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.frames import kept_in_worker, slices, texts
from tallymark.operators.joins import checkpointed_lookup

_WORDS = re.compile(r"\w+").findall
_LONGEST = 80  # letters of a run that is one word
_AT_ONCE = 20_000  # words looked up at once, which bounds the subwords held
_PIECE, _OVERLAP = 20, 10  # letters of the words that a longer run is cut to, and how many two of them share


@dataclass(frozen=True)
class Settings:
    """``max_docs`` and ``max_chars`` bound the training sample: how many texts, and their letters in all."""

    max_docs: int = 4_500
    max_chars: int = 18_000_000
    buckets: int = 1 << 17
    dims: int = 8
    shortest: int = 3
    longest: int = 6
    window: int = 2
    mean_steps: int = 150
    window_steps: int = 700
    refresh: int = 25  # steps after which the worst windows are looked for anew
    batch: int = 32
    rate: float = 0.2
    seed: int = 7


def words_of(text: str) -> list[str]:
    """The words of a text in lower case. Runs of more than 80 letters are cut at underscores and then to short pieces that
    overlap, so that any eleven letters in a row lie in one of them."""
    words = _WORDS(text.lower())
    if max(map(len, words), default=0) <= _LONGEST:
        return words
    return [piece for word in words for piece in (_pieces(word) if len(word) > _LONGEST else [word])]


def _pieces(run: str) -> list[str]:
    parts = filter(None, run.split("_"))
    return [p[i : i + _PIECE] for p in parts for i in range(0, max(len(p) - _OVERLAP, 1), _PIECE - _OVERLAP)]


def subwords(word: str, settings: Settings) -> list[int]:
    """Buckets of the character n-grams of ``<word>``, the whole of it included."""
    word = f"<{word}>"
    grams = {
        word[i : i + n] for n in range(settings.shortest, settings.longest + 1) for i in range(len(word) - n + 1)
    } | {word}
    return [zlib.crc32(g.encode()) % settings.buckets for g in sorted(grams)]


def _crc_steps() -> np.ndarray:
    """What a byte adds to a CRC-32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_steps()


def bags(words: Sequence[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """:func:`subwords` of many words at once: how many each has, and all of them, word by word.

    The n-grams that begin at a letter grow by one letter a step, and their hashes with them. Equal ones of a word are told
    by their 32-bit hash and count once.
    """
    marked = [f"<{w}>" for w in words]
    joined = "".join(marked)
    raw, codes = np.frombuffer(joined.encode(), np.uint8), np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    width = np.ones(len(codes), np.int64) + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)  # bytes in UTF-8
    first = np.cumsum(width) - width
    sizes = np.array([len(w) for w in marked], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    end = np.repeat(np.cumsum(sizes), sizes)
    begin, crc = np.arange(len(codes)), np.full(len(codes), 0xFFFFFFFF, np.uint32)
    found = [np.arange(len(words)) << 32 | np.array([zlib.crc32(w.encode()) for w in marked], np.int64)]
    for n in range(1, settings.longest + 1):
        fits = begin + n <= end[begin]
        begin, crc = begin[fits], crc[fits]
        letter = begin + n - 1
        for k in range(int(width[letter].max(initial=0))):
            more = width[letter] > k
            crc[more] = _CRC[(crc[more] ^ raw[first[letter[more]] + k]) & 0xFF] ^ (crc[more] >> 8)
        if n >= settings.shortest:
            found.append(owner[begin] << 32 | (crc ^ 0xFFFFFFFF).astype(np.int64))
    keys = np.sort(np.concatenate(found))
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return np.bincount(keys >> 32, minlength=len(words)), (keys & 0xFFFFFFFF) % settings.buckets


class Vocabulary:
    """The words of the training texts, each with its subwords as rows of a ragged array."""

    def __init__(self, settings: Settings):
        self._settings, self._of = settings, {}
        self._grams, self._sizes = array("i"), array("i")

    def ids(self, words: Sequence[str]) -> np.ndarray:
        for word in words:
            if word not in self._of:
                self._of[word] = len(self._of)
                grams = subwords(word, self._settings)
                self._grams.extend(grams)
                self._sizes.append(len(grams))
        return np.array([self._of[w] for w in words], np.int32)

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the subwords of each word begin, and all of them; the words themselves are forgotten."""
        self._of.clear()
        return np.concatenate([[0], np.cumsum(np.array(self._sizes, np.int64))]), np.array(self._grams, np.int32)


def _ragged(offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the elements of some rows of a ragged array, and the row (by its place in ``rows``) of each."""
    sizes = offsets[rows + 1] - offsets[rows]
    row = np.repeat(np.arange(len(rows)), sizes)
    first = np.cumsum(sizes) - sizes
    return np.arange(len(row)) - first[row] + offsets[rows][row], row


def window_means(values: np.ndarray, window: int) -> np.ndarray:
    """Mean of each ``window`` values in a row; the mean of all if there are fewer."""
    if len(values) <= window:
        return values.mean(keepdims=True) if len(values) else np.zeros(1)
    total = np.concatenate([[0.0], np.cumsum(values)])
    return (total[window:] - total[:-window]) / window


def _worst(doc: np.ndarray, leans: np.ndarray, window: int) -> np.ndarray:
    """The words of the worst window of a text."""
    first = int(np.argmax(window_means(leans[doc], window)))
    return doc[first : first + window]


def train(samples: Sequence[tuple[str | None, int]], settings: Settings = Settings()) -> tuple[np.ndarray, float]:
    """The logit difference of each bucket, and the bias, from texts with labels 0 and 1.

    With one class only (or no text at all) the score is that class (or one half) everywhere.
    """
    labels = np.array([y for _, y in samples], np.int64)
    if len(set(labels.tolist())) < 2:
        return np.zeros(settings.buckets), 0.0 if not len(labels) else (5.0 if labels[0] else -5.0)
    vocabulary = Vocabulary(settings)
    docs = [vocabulary.ids(words_of(t or "")) for t, _ in samples]
    offsets, grams = vocabulary.finish()
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1, 1, (settings.buckets, settings.dims)) / settings.dims
    softmax = rng.normal(0, 0.5, (settings.dims, 2))
    bias = np.zeros(2)
    g_vectors, g_softmax, g_bias = np.full(settings.buckets, 1e-8), np.full((settings.dims, 2), 1e-6), np.full(2, 1e-6)
    # both labels weigh alike: half of each batch is drawn from either, however rare it is
    own_of, left_of = [np.flatnonzero(labels == y) for y in (0, 1)], [np.zeros(0, np.int64)] * 2
    half = -(-settings.batch // 2)
    for step in range(settings.mean_steps + settings.window_steps):
        for y in (0, 1):
            while len(left_of[y]) < half:
                left_of[y] = np.concatenate([left_of[y], rng.permutation(own_of[y])])
        chosen = np.concatenate([left[:half] for left in left_of])
        left_of = [left[half:] for left in left_of]
        own = [docs[i] for i in chosen]
        if step >= settings.mean_steps:
            if (step - settings.mean_steps) % settings.refresh == 0:
                leans = (vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32)[grams]
                leans = np.add.reduceat(leans, offsets[:-1]) / np.diff(offsets)
            own = [_worst(doc, leans, settings.window) for doc in own]
        owner = np.repeat(np.arange(len(own)), [len(w) for w in own])
        weight = np.repeat([1 / max(len(w), 1) for w in own], [len(w) for w in own])
        words, used = np.unique(np.concatenate(own), return_inverse=True)
        spots, row = _ragged(offsets, words)
        sizes = np.bincount(row, minlength=len(words))
        mean = np.stack([np.bincount(row, v, len(words)) for v in vectors[grams[spots]].T], 1) / sizes[:, None]
        bags = np.stack([np.bincount(owner, v * weight, len(own)) for v in mean[used].T], 1)
        logits = bags @ softmax + bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        wrong = odds / odds.sum(axis=1, keepdims=True)
        wrong[np.arange(len(chosen)), labels[chosen]] -= 1
        wrong /= len(chosen)
        d_softmax, d_bias = bags.T @ wrong, wrong.sum(axis=0)
        slope = (wrong @ softmax.T)[owner] * weight[:, None]
        d_words = np.stack([np.bincount(used, v, len(words)) for v in slope.T], 1) / sizes[:, None]
        buckets, of = np.unique(grams[spots], return_inverse=True)
        d_vectors = np.stack([np.bincount(of, v, len(buckets)) for v in d_words[row].T], 1)
        # steps shrink with the squares of past gradients, for each bucket and for each weight of the softmax
        g_vectors[buckets] += (d_vectors**2).sum(axis=1)
        g_softmax += d_softmax**2
        g_bias += d_bias**2
        vectors[buckets] -= settings.rate * d_vectors / np.sqrt(g_vectors[buckets])[:, None]
        softmax -= settings.rate * d_softmax / np.sqrt(g_softmax)
        bias -= settings.rate * d_bias / np.sqrt(g_bias)
    return vectors @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0])


class Scorer:
    def __init__(self, leans: np.ndarray, bias: float, settings: Settings, max_words: int = 250_000):
        self._leans, self._bias, self._settings = leans, bias, settings
        self._known: dict[str, float] = {}
        self._max_words = max_words

    def _learn(self, words: list[str]) -> None:
        sizes, grams = bags(words, self._settings)
        total = np.add.reduceat(self._leans[grams], np.cumsum(sizes) - sizes)
        self._known.update(zip(words, (total / sizes).tolist(), strict=True))

    def __call__(self, text: str) -> float:
        return next(self.scores([text]))

    def scores(self, texts: Iterable[str]) -> Iterator[float]:
        """The score of each text; new words are learned for some texts at a time, whatever their lengths."""
        waiting, n = [], 0
        for text in texts:
            waiting.append(words_of(text))
            n += len(waiting[-1])
            if n >= _AT_ONCE:
                yield from self._scores(waiting)
                waiting, n = [], 0
        yield from self._scores(waiting)

    def _scores(self, docs: list[list[str]]) -> Iterator[float]:
        leans = self._leans_of(docs[0] if len(docs) == 1 else [w for words in docs for w in words])
        end = 0
        for words in docs:
            start, end = end, end + len(words)
            worst = window_means(leans[start:end], self._settings.window).max()
            yield float(1 / (1 + np.exp(-np.clip(worst + self._bias, -50, 50))))

    def _leans_of(self, words: list[str]) -> np.ndarray:
        known, leans = self._known, np.empty(len(words))
        for start in range(0, len(words), _AT_ONCE):
            part = words[start : start + _AT_ONCE]
            if len(known) > self._max_words:
                known.clear()
            if new := [w for w in dict.fromkeys(part) if w not in known]:
                self._learn(new)
            leans[start : start + len(part)] = list(map(known.__getitem__, part))
        return leans


def _scorer(leans: np.ndarray, bias: float, settings: Settings) -> Scorer:
    """The scorer of this Python worker: later tasks with the same model find the words already known."""
    name = ("scorer", zlib.crc32(leans.tobytes()), bias, settings)
    return kept_in_worker(name, lambda: Scorer(leans, bias, settings))


def sample(docs: DataFrame, labels: DataFrame, settings: Settings, *, key: str, text: str, label: str) -> list[tuple[str, int]]:
    """Labelled texts for training, about ``max_docs`` of them and ``max_chars`` letters, chosen by a hash of id and text.

    Each of the two labels has a rate of its own: half of both bounds is its, and what the rarer one leaves goes to the
    other. So rare labels are taken whole up to that half. :func:`train` weighs both labels alike, whatever their shares.
    Null labels, labels other than 0 and 1, and null ids are not learned from. Labels are joined by id; an id that has both
    labels gives two samples, and the texts of a repeated id are drawn one by one. A text counts once for each id and label,
    however often the row is repeated, so that the bounds hold.
    """
    known = labels.where(F.col(f"`{label}`").isin(0, 1) & F.col(f"`{key}`").isNotNull())
    known = known.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    # in 2^53 steps, so that the share of any number of rows is not rounded to none
    spot = F.pmod(F.xxhash64("id", "text", F.lit(settings.seed)), F.lit(1 << 53))
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).withColumn("spot", spot)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size")
    sized = known.distinct().join(rows.select("id", "spot", size), "id").distinct()
    found = {r["label"]: r for r in sized.groupBy("label").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()}
    docs_of = _shared({y: r["n"] for y, r in found.items()}, settings.max_docs)
    size_of = _shared({y: r["size"] for y, r in found.items()}, settings.max_chars)
    shares = {y: min(1.0, docs_of[y] / r["n"], size_of[y] / max(r["size"], 1)) for y, r in found.items()}
    chosen = F.lit(False)
    for y, share in shares.items():
        chosen = chosen | ((F.col("label") == y) & (F.col("spot") < int(share * (1 << 53))))
    # about ``max_docs`` rows, measured before they are broadcast, so that texts are not shuffled
    wanted = checkpointed_lookup(sized.where(chosen).select("id", "spot", "label"))
    drawn = rows.join(wanted, ["id", "spot"]).groupBy("id", "spot", "label").agg(F.first("text").alias("text")).collect()
    return [(r.text, r.label) for r in sorted(drawn, key=lambda r: (r.id, r.label, r.text or ""))]


def _shared(wanted: dict[int, int], bound: int) -> dict[int, float]:
    """``bound`` dealt to those who want a part of it: each half, or more where the other wants less."""
    return {y: max(bound / 2, bound - sum(w for z, w in wanted.items() if z != y)) for y in wanted}


def score(
    docs: DataFrame, leans: np.ndarray, bias: float, settings: Settings = Settings(), *, text: str = "text", name: str = "toxicity",
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with the score of ``text`` from 0 to 1; a column called ``name`` is replaced.

    A null, empty or wordless text has the score of the bias alone. Texts of any length are read whole. Repeated rows come
    out alike, and an empty table gives no rows. ``keep_text=False`` drops the text.
    """
    kept = [c for c in docs.columns if c.lower() != name.lower() and (keep_text or c != text)]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(f"`{text}`").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(leans.astype(np.float32))  # ``buckets`` numbers, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model.value, bias, settings)
        for batch in slices(batches, "text"):
            scores = pa.array(scorer.scores(texts(batch, "text")), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), scores], ["row", "score"])

    out = rows.mapInArrow(run, rows.select("row", F.lit(0.0).alias("score")).schema)
    return out.select(*(F.col("row").getField(c).alias(c) for c in kept), F.col("score").alias(name))
