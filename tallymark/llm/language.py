"""Language of texts by bit-sliced Bloom filters over character n-grams.

Every language has a Bloom filter of the n-grams it uses, and the filters lie side by side: a slot holds one bit for each
language. Looking an n-gram up is the AND of a few slots and gives all languages that contain it at once. A text counts,
for each language, the n-grams that have its bit; from that the expected number of false hits is taken off, which follows
from how full the language's filter is. The language with most n-grams left is the answer, its share of them the score.

The n-grams are counted in Spark over a bounded sample of labelled texts. A language's filter holds those that make up at
least ``rarest`` of its n-grams (so there are at most ``1 / rarest`` of them) and are not much rarer than in the language
that uses them most.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.frames import slices, texts
from tallymark.sources.scope import checkpointed

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """``docs`` and ``chars`` bound the training sample of each language; ``max_grams`` all filters together."""

    docs: int = 3_000
    chars: int = 8_000_000
    sizes: tuple[int, ...] = (3, 4)
    rarest: float = 5e-6
    least_count: int = 2
    least_ratio: float = 0.2
    max_grams: int = 2_000_000
    hashes: int = 4
    slots_per_gram: int = 8
    max_languages: int = 1_000
    seed: int = 11


@dataclass(frozen=True)
class Filters:
    """``bits[slot, word]`` has bit ``l`` of the languages set; ``false_hits`` is the chance of a false one for each."""

    languages: tuple[str, ...]
    bits: np.ndarray
    false_hits: np.ndarray
    hashes: int
    sizes: tuple[int, ...]


@functools.lru_cache(1)
def _alphabetic() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)], bool)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


PIECE = 1 << 19  # letters whose n-grams are looked at together


def _symbols(text: str, after_letter: bool) -> tuple[np.ndarray, bool, bool]:
    """Lower-case letters of a text with one blank for whatever lies between words, whether it ends in a letter, and has one."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = _alphabetic()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:1] |= after_letter
    return np.where(letter, points, 32)[keep].astype(np.uint64), bool(letter[-1]) if len(letter) else after_letter, bool(letter.any())


def _hashes(symbols: np.ndarray, n: int) -> np.ndarray:
    if len(symbols) < n:
        return np.zeros(0, np.uint64)
    h = np.full(len(symbols) - n + 1, n, np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + symbols[i : len(symbols) - n + 1 + i]
    return h


def _of_long(text: str, sizes: Sequence[int], piece: int) -> Iterator[tuple[np.ndarray, bool]]:
    """Hashes of the n-grams of one text, a piece at a time; what a piece needs of the one before is carried over."""
    carry, open_, widest, at = np.array([32], np.uint64), False, max(sizes), 0
    while at < len(text):
        cut = min(at + piece, len(text))
        if cut < len(text):  # not inside a word, whose lower case may depend on its end, unless it is very long
            cut = text.rfind(" ", at + 1, cut) + 1 or cut
        symbols, open_, has_letter = _symbols(text[at:cut], open_)
        stream = np.concatenate([carry, symbols, np.array([32], np.uint64) if cut == len(text) and open_ else symbols[:0]])
        # those that end in what is new; the first piece begins with all
        starts = {n: max(0, len(carry) - n + 1) if at else 0 for n in sizes}
        yield np.concatenate([_mixed(_hashes(stream[starts[n] :], n)) for n in sizes]), has_letter
        carry, at = stream[len(stream) - min(len(stream), widest - 1) :], cut


def grams(
    texts: Sequence[str], sizes: Sequence[int], piece: int = PIECE
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes of the n-grams of texts, the text of each, and which texts have a letter, about ``piece`` letters at a time.

    Letters are lower-cased. Whatever is no letter is one blank between words, and there is one at both ends.
    """
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= piece):
            size += len(texts[stop])
            stop += 1
        if size > piece:
            for found, has_letter in _of_long(texts[start], sizes, piece):
                yield found, np.full(len(found), start), np.array([start] if has_letter else [], np.int64)
        else:
            found, owner, has_letter = _of_short(texts[start:stop], sizes)
            yield found, owner + start, np.flatnonzero(has_letter) + start
        start = stop


def _of_short(texts: Sequence[str], sizes: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    spaced = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(spaced).encode("utf-32-le"), np.uint32)
    lengths = np.array([len(t) for t in spaced], np.int64)
    letter = _alphabetic()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[np.cumsum(lengths) - lengths] = True
    owner = np.repeat(np.arange(len(texts)), lengths)
    has_letter = np.bincount(owner[letter], minlength=len(texts)) > 0
    symbols = np.where(letter, points, 32)[keep].astype(np.uint64)
    owner = owner[keep]
    found, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for n in sizes:
        h = _hashes(symbols, n)
        whole = owner[: len(h)] == owner[len(owner) - len(h) :]
        found.append(_mixed(h[whole]))
        owners.append(owner[: len(h)][whole])
    return np.concatenate(found), np.concatenate(owners), has_letter


def _slots(hashes: np.ndarray, i: int, n_slots: int) -> np.ndarray:
    """The ``i``-th slot of each n-gram, by double hashing."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return ((hashes + np.uint64(i) * step) & np.uint64(n_slots - 1)).astype(np.intp)


def build(languages: Sequence[str], hashes: np.ndarray, language: np.ndarray, settings: Settings) -> Filters:
    """Filters from pairs of an n-gram's hash and the number of a language that contains it."""
    most = int(np.bincount(language, minlength=max(len(languages), 1)).max(initial=0))
    n_slots = 1 << max(10, (settings.slots_per_gram * most - 1).bit_length())
    words = -(-max(len(languages), 1) // 8)
    bits = np.zeros((n_slots, words), np.uint8)
    fill = np.zeros(len(languages))
    for number in range(len(languages)):
        own = hashes[language == number]
        for i in range(settings.hashes):
            bits[_slots(own, i, n_slots), number // 8] |= np.uint8(1 << number % 8)
        fill[number] = (bits[:, number // 8] >> (number % 8) & 1).mean()
    return Filters(tuple(languages), bits, fill**settings.hashes, settings.hashes, settings.sizes)


_BITS_OF = (np.arange(256)[:, None] >> np.arange(8)[None] & 1).astype(np.float64)


def identify(texts: Sequence[str], filters: Filters) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    n, has_letter = np.zeros(len(texts)), np.zeros(len(texts), bool)
    hits = np.zeros((len(texts), 8 * filters.bits.shape[1]))
    for hashes, owner, lettered in grams(texts, filters.sizes):
        has_letter[lettered] = True
        first = int(owner.min(initial=len(texts)))
        wide = max(int(owner.max(initial=-1)) + 1 - first, 0)
        owner = owner - first
        n[first : first + wide] += np.bincount(owner, minlength=wide)
        masks = filters.bits[_slots(hashes, 0, len(filters.bits))]
        for i in range(1, filters.hashes):
            masks &= filters.bits[_slots(hashes, i, len(filters.bits))]
        for w in range(masks.shape[1]):
            counts = np.bincount(owner * 256 + masks[:, w], minlength=wide * 256).reshape(-1, 256)
            hits[first : first + wide, 8 * w : 8 * w + 8] += counts @ _BITS_OF
    hits = hits[:, : len(filters.languages)]
    if not filters.languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    true = np.maximum(0, hits - n[:, None] * filters.false_hits) / (1 - np.minimum(filters.false_hits, 0.99))
    total = true.sum(axis=1)
    best = true.argmax(axis=1)  # ties and texts without any known n-gram: the more frequent language, which comes first
    score = np.divide(true[np.arange(len(best)), best], total, out=np.zeros(len(best)), where=total > 0)
    names = [filters.languages[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), has_letter.tolist(), strict=True)]
    return names, np.where(has_letter, score, 0.0)


def fit(docs: DataFrame, settings: Settings = Settings(), *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Filters:
    """Filters from the labelled rows of ``docs``; rows without a label or text teach nothing.

    The sample of a language is chosen by a hash of ``key`` and text, so that null or equal ids are no matter; equal rows
    are drawn together, and count as often as they occur. Languages are ordered by their number of rows, then by name. An
    empty table, or one without labels, gives filters that know no language.
    """
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")
    ).dropna(subset=["text", "lang"])
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("chars"))
    sizes = sizes.limit(settings.max_languages + 1).collect()
    if len(sizes) > settings.max_languages:
        raise ValueError(f"more than {settings.max_languages} languages: raise max_languages or clean the column")
    sizes.sort(key=lambda r: (-r.n, r.lang))
    languages = [r.lang for r in sizes]
    if not languages:
        return build([], np.zeros(0, np.uint64), np.zeros(0, np.int64), settings)
    share = F.create_map(
        *(F.lit(x) for r in sizes for x in (r.lang, min(1.0, settings.docs / r.n, settings.chars / max(r.chars, 1))))
    )
    # in 2^53 steps, so that the share of any number of rows is not rounded to none
    drawn = F.pmod(F.xxhash64("key", "text", F.lit(settings.seed)), F.lit(1 << 53)) < share[F.col("lang")] * float(1 << 53)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            names, number = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            for hashes, owner, _ in grams(texts(batch, "text"), settings.sizes):
                for i in np.unique(number[owner]).tolist():
                    gram, n = np.unique(hashes[number[owner] == i], return_counts=True)
                    columns = [pa.array([str(names[i])] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    counts = rows.where(drawn).select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    counts = checkpointed(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    totals = {r.lang: r.total for r in counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    if not totals:
        return build(languages, np.zeros(0, np.uint64), np.zeros(0, np.int64), settings)
    rarest = max(settings.rarest, len(languages) / settings.max_grams)
    total = F.create_map(*(F.lit(x) for pair in totals.items() for x in pair))[F.col("lang")]
    rated = counts.withColumn("rate", F.col("n") / total)
    most = rated.groupBy("gram").agg(F.max("rate").alias("most"))
    kept = (
        rated.where((F.col("rate") >= rarest) & (F.col("n") >= settings.least_count))
        .join(most, "gram")
        .where(F.col("rate") >= settings.least_ratio * F.col("most"))
        .select("lang", "gram")
        .toPandas()  # at most max_grams rows
    )
    place = {name: i for i, name in enumerate(languages)}
    numbers = kept["lang"].map(place).to_numpy(np.int64)
    return build(languages, kept["gram"].to_numpy(np.int64).view(np.uint64), numbers, settings)


def detect(
    docs: DataFrame, filters: Filters, *, text: str = "text", name: str = "lang_pred", score: str = "score", keep_text: bool = True
) -> DataFrame:
    """``docs`` with the language of ``text`` and its score from 0 to 1; columns of these names are replaced.

    A null text, or one without a letter, is ``und`` with score 0. A text that no filter knows gets the most frequent
    language with score 0. Texts of any length are read whole, a piece at a time. Repeated rows come out alike, and an empty
    table gives no rows.
    """
    own = {name.lower(), score.lower()}
    kept = [c for c in docs.columns if c.lower() not in own and (keep_text or c != text)]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(f"`{text}`").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # bounded by max_grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            names, scores = identify(texts(batch, "text"), shared.value)
            columns = [batch.column("row"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "name", "score"])

    out = rows.mapInArrow(run, rows.select("row", F.lit("").alias("name"), F.lit(0.0).alias("score")).schema)
    return out.select(
        *(F.col("row").getField(c).alias(c) for c in kept), F.col("name").alias(name), F.col("score").alias(score)
    )
