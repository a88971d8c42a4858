"""Fill-in-the-middle transformation with a piecewise-linear learned rank index over token boundaries.

A block of texts has one ascending array of boundary offsets. The index fits it by segments of a bounded error, grown
greedily as long as a line through their first boundary stays within the error, and keeps one signed byte a boundary: its distance from the
line, rounded. A cut after k units is the boundary of a rank; it is predicted from the rank's segment and corrected by
the stored residual, which is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, prepare, released

#: What stands before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")


class RankIndex:
    """Ascending offsets by their ranks: linear segments with a bounded error, and each offset's residual."""

    def __init__(self, offsets: np.ndarray, error: int = 100, window: int = 1024):
        if not 0 <= error <= 127:
            raise ValueError("residuals are signed bytes: error must be from 0 to 127")
        n, at = len(offsets), 0
        starts, slopes = [], []
        self.residuals = np.zeros(n, np.int8)
        while at < n:
            end, slope = self._segment(offsets, at, error, window)
            starts.append(at)
            slopes.append(slope)
            self.residuals[at:end] = offsets[at:end] - offsets[at] - np.rint(slope * np.arange(end - at)).astype(np.int64)
            at = end
        self.starts, self.slopes = np.array(starts, np.int64), np.array(slopes)
        self.bases = offsets[self.starts].astype(np.int64) if n else np.zeros(0, np.int64)

    @staticmethod
    def _segment(offsets: np.ndarray, at: int, error: int, window: int) -> tuple[int, float]:
        """Where the longest segment from at on ends, and a slope that keeps all its offsets within the error."""
        low, high, done = -np.inf, np.inf, at + 1
        while done < len(offsets):
            end = min(done + window, len(offsets))
            steps, rise = np.arange(done - at, end - at), offsets[done:end] - offsets[at]
            lows = np.maximum(np.maximum.accumulate((rise - error) / steps), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / steps), high)
            apart = np.flatnonzero(lows > highs)
            kept = int(apart[0]) if len(apart) else end - done
            if kept:
                low, high = lows[kept - 1], highs[kept - 1]
            done += kept
            if len(apart):
                break
            window *= 2
        return done, float((low + high) / 2) if np.isfinite(low) else 0.0

    def __getitem__(self, ranks: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.starts, ranks, side="right") - 1
        predicted = self.bases[s] + np.rint(self.slopes[s] * (ranks - self.starts[s])).astype(np.int64)
        return predicted + self.residuals[ranks]


def boundaries(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where units end in UTF-8 texts that lie one after the other, in bytes; starts has every text's start and the last one's end.

    A unit is white space with the run of other characters after it; white space at a text's end is one of its own.
    """
    ends = np.zeros(len(data), bool)
    for at in range(0, len(data), 1 << 22):  # a slice's masks at a time
        part = data[at : at + (1 << 22) + 1]
        white = (part == 32) | ((part >= 9) & (part <= 13))
        ends[at : at + len(part) - 1] = ~white[:-1] & white[1:]
    ends[starts[1:][starts[1:] > starts[:-1]] - 1] = True
    return np.flatnonzero(ends) + 1


def chars(data: np.ndarray) -> int:
    """Code points in UTF-8 bytes: those that don't continue one."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def transform_block(data: np.ndarray, starts: np.ndarray, draws: list[np.ndarray], shares: tuple[int, int], sentinels: tuple[bytes, ...], error: int):
    """(n, form, prefix_chars, middle_chars, output) of every text of a block."""
    ends = boundaries(data, starts)
    first = np.searchsorted(ends, starts, side="right")  # a boundary at a text's start belongs to the text before
    index, n = RankIndex(ends, error), np.diff(first)
    del ends
    cuts = [h % (n + 1) for h in draws[:2]]
    places = [starts[:-1].copy(), starts[:-1].copy()]
    for place, units in zip(places, (np.minimum(*cuts), np.maximum(*cuts)), strict=True):
        some = units > 0
        place[some] = index[(first[:-1] + units - 1)[some]]
    rewritten, spm = draws[2] % 100 < shares[0], draws[3] % 100 < shares[1]
    pre, suf, mid = sentinels
    for i, (a, p, m, z) in enumerate(zip(starts[:-1].tolist(), *(x.tolist() for x in places), starts[1:].tolist(), strict=True)):
        text = data[a:z].tobytes()
        if not text or not rewritten[i] or any(s in text for s in sentinels):
            yield int(n[i]), "plain", None, None, text
            continue
        prefix, middle, suffix = text[: p - a], text[p - a : m - a], text[m - a :]
        parts = (suf, suffix, pre, prefix, mid, middle) if spm[i] else (pre, prefix, suf, suffix, mid, middle)
        yield int(n[i]), "spm" if spm[i] else "psm", chars(data[a:p]), chars(data[p:m]), b"".join(parts)


def fill_in_middle(docs: DataFrame, text: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), seed: int = 42, percent: int = 50, spm_percent: int = 80, sentinels: tuple[str, str, str] = SENTINELS, error: int = 100) -> DataFrame:
    """Columns of keep, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output of every row.

    One narrow pass, no shuffle. Draws are the first four groups of sha256(`seed:id`), so that a row's cut doesn't depend on its place; a
    null id draws as an empty one. A null or empty text, one that holds a sentinel, and those not drawn stay plain; so repeated
    rows are cut alike, and texts of any length are cut as a whole. Of a very long text a task holds the text, its output and about
    two bytes for each of its own. Columns other than keep, id_col and text aren't read, so names may clash; keep's own are
    named as they were, and must not be among the results' names. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[id_col].cast("string"), F.lit(""))), 256)
    names = fresh(docs.select(*keep), "text", *[f"h{i}" for i in range(1, 5)])
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(name) for i, name in enumerate(names[1:])]
    chosen = docs.select(*keep, F.coalesce(docs[text], F.lit("")).alias(names[0]), *draws)
    schema = T.StructType([*chosen.schema.fields[: len(keep)], *T._parse_datatype_string("n long, form string, prefix_chars long, middle_chars long, output string").fields])
    marks = tuple(s.encode() for s in sentinels)

    def cut(batches):
        for batch in released(batches):
            if not batch.num_rows:
                continue
            column = batch.column(len(keep)).cast(pa.large_binary())
            starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]]
            found = transform_block(data, starts - starts[0], [c.to_numpy(zero_copy_only=False) for c in batch.columns[len(keep) + 1 :]], (percent, spm_percent), marks, error)
            n, form, prefix, middle, output = zip(*found, strict=True)
            made = [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=schema.names)

    return chosen.mapInArrow(cut, schema)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that a row of fill_in_middle was made from, by its output and form alone."""
    parts = F.split(output, "|".join(rf"\Q{s}\E" for s in sentinels), -1)
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
