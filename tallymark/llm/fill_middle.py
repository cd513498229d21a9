"""Fill-in-the-middle transformation, with cuts found by a piecewise-linear learned rank index.

The index of a text learns where its words end: the offset of the end of the k-th word is a nearly straight function of k, so
straight segments are fitted to all offsets, each as long as an error of ``ERROR`` characters allows (a cone of slopes that
narrows from word to word). The error of each offset is stored in one byte. To find a cut, the segment of its word
predicts the offset and the stored residual corrects it exactly. Texts are read in steps, so that a very long text takes
one byte a word beside itself.

Null texts are empty. Empty texts, and texts that hold one of the three markers, stay plain. A null id draws as an empty
one would. What is drawn depends on id and seed alone: repeated rows come out alike. An empty table gives no rows. Other
columns may have any name; one called like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymark.llm.frames import slices, texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ERROR = 100  # characters; with the rounding of a prediction it fits a signed byte
STEP = 1 << 20


def boundaries(text: str, step: int = STEP) -> Iterator[np.ndarray]:
    """Offsets at which the words of ``text`` end, blanks counting to the word behind them and those at the end as one more."""
    for start in range(0, len(text), step):
        part = text[start : start + step]
        plain = part.isascii()
        codes = np.frombuffer(part.encode("ascii" if plain else "utf-32-le"), np.uint8 if plain else np.uint32)
        blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
        after = text[start + step : start + step + 1]
        ends = ~blank
        ends[:-1] &= blank[1:]
        ends[-1] &= not after or after in " \t\n\v\f\r"
        found = np.flatnonzero(ends) + (start + 1)
        yield np.append(found, len(text)) if not after and blank[-1] else found


class RankIndex:
    """Offset of every word end of a text by its rank; rank 0 is the beginning."""

    def __init__(self, text: str, error: int = ERROR, step: int = STEP):
        self._error = error
        self._first: list[int] = []
        self._base: list[int] = []
        self._slope: list[float] = []
        residuals, n = [self._fit(np.zeros(1, np.int64), 0)], 1
        for part in boundaries(text, step):
            residuals.append(self._fit(part, n))
            n += len(part)
        self._residuals = np.concatenate(residuals)
        self._starts = np.array(self._first)

    def __len__(self) -> int:
        """Words of the text."""
        return len(self._residuals) - 1

    @property
    def segments(self) -> int:
        return len(self._first)

    def _fit(self, offsets: np.ndarray, rank: int) -> np.ndarray:
        """Add segments for some offsets; returns their residuals."""
        residuals, at, width = np.zeros(len(offsets), np.int8), 0, 256
        while at < len(offsets):
            while True:
                rise = offsets[at + 1 : at + width] - offsets[at]
                run = np.arange(1, len(rise) + 1)
                low = np.maximum.accumulate((rise - self._error) / run)
                high = np.minimum.accumulate((rise + self._error) / run)
                n = int(np.searchsorted(low > high, True))  # once the cone is empty it stays so
                if n < len(rise) or at + width >= len(offsets):
                    break
                width *= 2
            slope = float(low[n - 1] + high[n - 1]) / 2 if n else 0.0
            self._first.append(rank + at)
            self._base.append(int(offsets[at]))
            self._slope.append(slope)
            residuals[at + 1 : at + 1 + n] = rise[:n] - np.rint(slope * run[:n]).astype(np.int64)
            at, width = at + 1 + n, max(64, 2 * n)
        return residuals

    def predicted(self, rank: int) -> int:
        segment = int(np.searchsorted(self._starts, rank, "right")) - 1
        return self._base[segment] + int(np.rint(self._slope[segment] * (rank - self._first[segment])))

    def offset(self, rank: int) -> int:
        return self.predicted(rank) + int(self._residuals[rank])


def _draws(key: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", rate: int = 50, spm: int = 80, seed: int = 42,
    name: str = "fim", keep_text: bool = True,
) -> DataFrame:
    """``docs`` with a struct ``n, form, prefix_chars, middle_chars, output``.

    ``n`` counts the words. ``rate`` percent of the texts are cut at two words drawn from the id, and of these ``spm``
    percent come out as suffix, prefix, middle, the rest as prefix, suffix, middle; ``form`` is ``spm``, ``psm`` or ``plain``.
    ``keep_text=False`` drops the text itself.
    """
    kept = [c for c in docs.columns if c != text and c.lower() != name.lower()]
    h = _draws(F.col(f"`{key}`"), seed)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(body, F.lit(marker))
    plain = (body == "") | marked | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(f"`{text}`").alias("text"), form.alias("form"),
        h[0].alias("h1"), h[1].alias("h2"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            columns = (batch.column(c).to_pylist() for c in ("form", "h1", "h2"))
            found = [_cuts(t, *of) for t, *of in zip(texts(batch, "text"), *columns, strict=True)]
            numbers = [pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else ([], [], []))]
            own = [batch.column(c) for c in ("row", "text", "form")]
            yield pa.RecordBatch.from_arrays([*own, *numbers], ["row", "text", "form", "n", "first", "second"])

    numbers = StructType.fromDDL("n long, first long, second long")
    found = rows.mapInArrow(run, StructType([*rows.drop("h1", "h2").schema, *numbers]))
    body = F.coalesce("text", F.lit(""))
    prefix, suffix = F.substr(body, F.lit(1), F.col("first").cast("int")), F.substr(body, (F.col("second") + 1).cast("int"))
    middle = F.substr(body, (F.col("first") + 1).cast("int"), (F.col("second") - F.col("first")).cast("int"))
    p, s, m = map(F.lit, (PREFIX, SUFFIX, MIDDLE))
    output = (
        F.when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(body)
    )
    result = F.struct(
        "n", "form", F.col("first").alias("prefix_chars"), (F.col("second") - F.col("first")).alias("middle_chars"),
        output.alias("output"),
    )
    own = {c: F.col("row").getField(c) for c in kept} | ({text: F.col("text")} if keep_text and text != name else {})
    return found.select(*(own[c].alias(c) for c in docs.columns if c in own), result.alias(name))


def _cuts(text: str, form: str, h1: int, h2: int) -> tuple[int, int | None, int | None]:
    if form == "plain":
        return sum(map(len, boundaries(text))), None, None
    index = RankIndex(text)
    first, second = sorted(h % (len(index) + 1) for h in (h1, h2))
    return len(index), index.offset(first), index.offset(second)


def restored(output: Column, form: Column) -> Column:
    """The text from which ``output`` was made. No marker overlaps itself or another, so the first one found is the right one."""
    body = F.substr(output, F.lit(4))
    head, rest = _halves(body, F.when(form == "spm", PREFIX).otherwise(SUFFIX))
    tail, middle = _halves(rest, F.lit(MIDDLE))
    whole = F.when(form == "spm", F.concat(tail, middle, head)).otherwise(F.concat(head, middle, tail))
    return F.when(form == "plain", output).otherwise(whole)


def _halves(text: Column, marker: Column) -> tuple[Column, Column]:
    at = F.instr(text, marker)
    return F.substr(text, F.lit(1), at - 1), F.substr(text, at + 3)
