"""Periodic runs of words by online dyadic square catching.

Words arrive one after the other. Whenever a block of ``B`` = 1, 2, 4, ... words is complete, a catcher is set on it:
a square whose halves are ``2 B`` to ``4 B - 1`` words long has such a block, aligned to ``B``, within its first half,
and the block comes back exactly one period later. So at each size only the two catchers (three for ``B`` = 1) whose
distance fits watch an appended word: the suffix of ``B`` words that it ends is compared with their blocks. Catches
of neighbouring blocks at one distance are chained while they come in. Once the next block fails, the chain is
extended word-wise on both sides: a chain that spans twice its period is a square, and all squares of one period
that touch are one run.

Suffixes are compared by hash, which can never miss one; every run is then compared word by word before it is
reported, so a collision costs time and not the result. The work is O(n log n) for n words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.llm.common import free_name, in_slices, map_arrow, ship_package
from cdcmart.llm.words import mixed

LEAST_EXPONENT = 4
LEAST_LENGTH = 6

# Words appended at once: what bounds the temporary arrays, not the result.
_PIECE = 1 << 18

_BASE = 0xD1342543DE82EF95
_UNBASE = pow(_BASE, -1, 1 << 64)

Run = tuple[int, int, int]  # start, length, period


class _Grown:
    """An array that is appended to."""

    def __init__(self, dtype: type, first: int | None = None):
        self.data = np.zeros(1024, dtype)
        self.size = 0
        if first is not None:
            self.data[0], self.size = first, 1

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data[: self.size], np.zeros(max(need, 2 * self.size) - self.size, self.data.dtype)])
        self.data[self.size : need] = values
        self.size = need


class SquareCatchers:
    """Catchers on all complete blocks of one stream of words; ``append`` may be given any number of them.

    Runs have their smallest period, up to ``most_period``, and are reported once what follows shows that they
    cannot grow and that no smaller period describes them; ``finish`` reports those that reach the end.
    """

    def __init__(
        self, least_exponent: int = LEAST_EXPONENT, least_length: int = LEAST_LENGTH, most_period: int | None = None
    ):
        if least_exponent < 2:
            raise ValueError("a run holds a square: its exponent is 2 or more")
        self.exponent, self.length, self.most_period = least_exponent, least_length, most_period
        self._words = _Grown(np.int64)
        self._sums = _Grown(np.uint64, 0)
        self._up = _Grown(np.uint64, 1)  # powers of the base, and of its inverse
        self._down = _Grown(np.uint64, 1)
        self._chains: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self._found: dict[tuple[int, int], int] = {}  # (start, end) of a run: its smallest known period

    def append(self, words: np.ndarray) -> list[Run]:
        """Read on; ``words`` are integers that are equal where the words are."""
        out: list[Run] = []
        for at in range(0, len(words), _PIECE):
            out += self._append(np.asarray(words[at : at + _PIECE], np.int64))
        return out

    def finish(self) -> list[Run]:
        """What still reaches the end of the stream."""
        for block in sorted(self._chains):
            self._close(block, *self._chains.pop(block))
        return self._released(ended=True)

    def _append(self, words: np.ndarray) -> list[Run]:
        before = self._words.size
        self._words.extend(words)
        for powers, base in ((self._up, _BASE), (self._down, _UNBASE)):
            steps = np.full(len(words) + 1, base, np.uint64)
            steps[0] = powers.data[powers.size - 1]
            powers.extend(np.multiply.accumulate(steps)[1:])
        terms = mixed(words.view(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * self._up.data[before : before + len(words)]
        terms[:1] += self._sums.data[self._sums.size - 1 : self._sums.size]
        self._sums.extend(np.cumsum(terms))
        block = 1
        while self._may_hold(block):
            self._watch(block, before)
            block *= 2
        return self._released()

    def _may_hold(self, block: int) -> bool:
        period = 1 if block == 1 else 2 * block
        return period * self.exponent <= self._words.size and (self.most_period is None or period <= self.most_period)

    def _hashes(self, first: int | np.ndarray, size: int | np.ndarray, stop: int | None = None) -> np.ndarray:
        """Hash of the ``size`` words from each of ``first``, or from ``first`` to ``stop`` one by one."""
        sums, down = self._sums.data, self._down.data
        if stop is not None:
            return (sums[first + size : stop + size] - sums[first:stop]) * down[first:stop]
        return (sums[first + size] - sums[first]) * down[first]

    def _watch(self, block: int, before: int) -> None:
        """Compare the suffixes that the new words end with the blocks that wait for them; chain what is caught."""
        seen = self._chains.get(block)
        # A size that begins to be of use only now has missed the words before.
        first = max(0, before - block + 1) if seen is not None else 0
        stop = self._words.size - block + 1
        suffixes = self._hashes(first, block, stop)
        low, high = max(0, first // block - 3), (stop - 1) // block
        blocks = np.repeat(self._hashes(np.arange(low, high + 1) * block, block), block)
        periods, starts = [], []
        for distance in (1, 2, 3) if block == 1 else (2, 3):
            begin = max(first, (low + distance) * block)  # the first suffix with a block so far before it
            if begin >= stop:
                continue
            at = begin - (low + distance) * block
            hits = begin + np.flatnonzero(suffixes[begin - first :] == blocks[at : at + stop - begin])
            caught = (hits // block - distance) * block
            starts.append(caught)
            periods.append(hits - caught)
        old = seen if seen is not None else (np.zeros(0, np.int64),) * 3
        period = np.concatenate([old[0], *periods])
        begin = np.concatenate([old[1], *starts])
        last = np.concatenate([old[2], *starts])
        order = np.lexsort((begin, period))
        period, begin, last = period[order], begin[order], last[order]
        new = np.ones(len(period), bool)
        new[1:] = (period[1:] != period[:-1]) | (begin[1:] != last[:-1] + block)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(period))[: len(heads)] - 1
        period, begin, last = period[heads], begin[heads], last[tails]
        # The next block of a chain has failed once the words that it should come back as have been read.
        over = last + period + 2 * block <= self._words.size
        self._chains[block] = (period[~over], begin[~over], last[~over])
        self._close(block, period[over], begin[over], last[over])

    def _close(self, block: int, period: np.ndarray, begin: np.ndarray, last: np.ndarray) -> None:
        """Chains that are over: those long enough are extended by less than a block on each side and kept as runs."""
        least = np.maximum((self.exponent - 1) * period, self.length - period)
        may = last - begin + 3 * block - 2 >= least
        if self.most_period is not None:
            may &= period <= self.most_period
        period, begin, last = period[may], begin[may], last[may]
        if not len(period):
            return
        left, right = self._extended(block, period, begin, last)
        start, end = begin - left, last + block + right + period
        long = end - start - period >= least[may]
        # Smaller periods first: a multiple of the smallest one is told by the same start and end.
        for i in np.flatnonzero(long).tolist():
            self._keep(int(start[i]), int(end[i]), int(period[i]), block, int(begin[i]), int(last[i]))

    def _extended(self, block: int, period: np.ndarray, begin: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words by which the chains go on to the left and right, by halving steps."""
        left, right = np.zeros_like(begin), np.zeros_like(begin)
        step = block // 2
        while step:
            at = begin - left - step
            fits = np.flatnonzero(at >= 0)
            same = self._hashes(at[fits], step) == self._hashes(at[fits] + period[fits], step)
            left[fits[same]] += step
            at = last + block + right
            fits = np.flatnonzero(at + period + step <= self._words.size)
            same = self._hashes(at[fits], step) == self._hashes(at[fits] + period[fits], step)
            right[fits[same]] += step
            step //= 2
        return left, right

    def _keep(self, start: int, end: int, period: int, block: int, begin: int, last: int) -> None:
        known = self._found.get((start, end))
        if known is not None and period % known == 0:
            return
        words, size = self._words.data, self._words.size
        if (
            np.array_equal(words[start : end - period], words[start + period : end])
            and (start == 0 or words[start - 1] != words[start - 1 + period])
            and (end == size or words[end] != words[end - period])
        ):
            self._found[start, end] = min(period, known or period)
            return
        # A collision: look at every word the chain may hold.
        low, high = max(0, begin - block + 1), min(last + 2 * block, size - period)
        same = np.zeros(high - low + 2, np.int8)
        same[1:-1] = words[low:high] == words[low + period : high + period]
        turns = np.flatnonzero(np.diff(same)) + low
        for a, b in zip(turns[0::2].tolist(), turns[1::2].tolist()):
            if b - a >= max((self.exponent - 1) * period, self.length - period):
                known = self._found.get((a, b + period))
                if known is None or known % period == 0:
                    self._found[a, b + period] = period

    def _released(self, ended: bool = False) -> list[Run]:
        """Runs of which all chains are over: a chain ends less than a quarter of its length behind its run."""
        size = self._words.size
        done = [(a, b) for a, b in self._found if ended or b + (b - a) // 4 < size]
        return sorted((a, b - a, self._found.pop((a, b))) for a, b in done)


def runs_of(
    texts: list[np.ndarray], least_exponent: int = LEAST_EXPONENT, least_length: int = LEAST_LENGTH
) -> list[list[Run]]:
    """The runs of each array of words, by start, then period.

    Texts of about the same length are read as one stream, with a word of its own after each, so that short
    ones pass only the block sizes they have room for.
    """
    out: list[list[Run]] = [[] for _ in texts]
    classes: dict[int, list[int]] = {}
    for i, words in enumerate(texts):
        if len(words) >= max(least_length, least_exponent):
            classes.setdefault(len(words).bit_length(), []).append(i)
    for members in classes.values():
        longest = max(len(texts[i]) for i in members)
        catchers = SquareCatchers(least_exponent, least_length, longest // least_exponent)
        stream = [part for i in members for part in (texts[i], np.array([-1 - i]))]
        starts = np.cumsum([0, *(len(texts[i]) + 1 for i in members)])
        found = catchers.append(np.concatenate(stream)) + catchers.finish()
        places = np.searchsorted(starts, [run[0] for run in found], side="right") - 1
        for (start, length, period), place in zip(found, places.tolist()):
            out[members[place]].append((start - int(starts[place]), length, period))
    for runs in out:
        runs.sort(key=lambda run: (run[0], run[2]))
    return out


def split_words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: what the bytes 0x20 and 0x09 to 0x0D stand between."""
    return text.split()


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


_RUNS = T.ArrayType(
    T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")]), False
)


def find_runs(
    docs: DataFrame,
    text: str = "text",
    least_exponent: int = LEAST_EXPONENT,
    least_length: int = LEAST_LENGTH,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add to each row: n_words, runs (array of start, length, period in words, by start, then period) and collapsed
    (the text without what its runs repeat, words joined by one space).

    A run is a stretch of words with smallest period ``period`` that no neighbouring word extends, of
    ``least_exponent`` periods and ``least_length`` words or more. Null and empty texts have no words, no runs and
    collapse to an empty text; an empty table gives one. Every row is judged for itself, so repeated rows each get
    their result. ``keep`` names the columns that stay (all of them if not given); added names that are taken get
    underscores.
    """
    spark = docs.sparkSession
    ship_package(spark)
    fields = [f for f in docs.schema.fields if keep is None or f.name in keep]
    others = docs.select(*[f"`{f.name}`" for f in fields])
    names = [free_name(others, n) for n in ("n_words", "runs", "collapsed")]
    schema = T.StructType(
        [*fields, *(T.StructField(n, t) for n, t in zip(names, (T.LongType(), _RUNS, T.StringType())))]
    )
    source = docs.columns.index(text)
    kept = [docs.columns.index(f.name) for f in fields]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, source):
            texts = [split_words(t or b"") for t in batch.column(source).cast(pa.binary()).to_pylist()]
            numbers: dict[bytes, int] = dict(zip({w for words in texts for w in words}, count()))
            ids = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in texts]
            found = runs_of(ids, least_exponent, least_length)
            flat = np.array([run for runs in found for run in runs], np.int64).reshape(-1, 3)
            ends = np.cumsum([0, *map(len, found)])
            columns = [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)]
            listed = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, ["start", "length", "period"])
            )
            plain = [collapsed(words, runs) for words, runs in zip(texts, found)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k) for k in kept),
                    pa.array(list(map(len, texts)), pa.int64()),
                    listed,
                    pa.array(plain, pa.binary()).cast(pa.string()),
                ],
                schema.names,
            )

    return map_arrow(docs, step, schema)


def with_repeats(doc_id: Column, text: Column) -> Column:
    """The text of the tenth of the documents that the checksum of their id picks, made periodic from some word on:
    word ``i`` at or after ``a`` becomes word ``a + (i - a) % p``. Other texts, also those of a null id, stay."""
    picked = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    size, rest = F.size(words), F.floor(picked / 10).cast("long")
    first = (rest % size).cast("int")
    period = (F.lit(1) + F.floor((size - first) / (3 + rest % 8))).cast("int")
    times = F.ceil((size - first) / period).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, first + 1, period), times)), F.lit(1), size - first)
    whole = F.concat(F.slice(words, F.lit(1), first), tail)
    return F.when((picked % 10 == 0) & (size > 0), F.array_join(whole, " ")).otherwise(text)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run (start, length, period, exponent_milli) and the digests of all runs and of the
    collapsed text, of every document of which a tenth is made periodic by :func:`with_repeats`.

    Null and empty texts have no runs: four nulls and the digests of an empty text. Rows with a null doc_id and
    repeated rows each get their result; other columns are not read.
    """
    changed = docs.select("doc_id", with_repeats(F.col("doc_id"), F.col("text")).alias("text"))
    found = find_runs(changed, keep=["doc_id"])
    # The runs come by start, then period, so the first of equal exponents stays.
    best = F.aggregate(
        "runs",
        F.expr("cast(null as struct<start:bigint,length:bigint,period:bigint>)"),
        lambda a, r: F.when(a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
