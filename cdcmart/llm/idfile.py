"""Token ids in files of bit-plane shuffled blocks.

A file is a run of segments. A segment is

    magic (8) | header length (4) | header, JSON | planes | planes' chunk index | end mark (8)

The ids of a segment are cut into blocks of a fixed number of ids. Each block is transposed: plane
``k`` holds byte ``k`` (or bit ``k``) of all its ids, and each plane is compressed with zstandard by
itself, so the nearly constant high planes cost next to nothing. The chunk index has the
length of every compressed plane, so one block is read without the others. The documents of a
segment (id, tokens in this segment, whether it continues) are stored the same way. A segment ends with
a document; a document of more ids than a segment holds has several segments of its own.

Files are written by Spark's own text writer, whole documents' segments a row and the end mark as line separator:
task commits and any file system Spark knows come with it. A file ends after a fixed number of rows, so
its size does not follow that of its key range.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdcmart.llm.common import in_slices, ship_package

MAGIC = b"IDPLANE1"
END = b"\x00ENDSEG\n"

# Ids of a block, and the most ids of a segment.
BLOCK = 1 << 16
SEGMENT = 1 << 20

# Rows of a file: some 4.5 MB each at most, but for longer documents. A reader holds a whole file.
FILE_ROWS = 16

# Characters of the text by which the rows of one key are dealt out: the driver samples them.
PREFIX = 256


def to_planes(values: np.ndarray, unit: str = "byte") -> list[bytes]:
    """The byte or bit planes of a block, lowest first."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize)
    if unit == "byte":
        return [plane.tobytes() for plane in np.ascontiguousarray(raw.T)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(plane).tobytes() for plane in np.ascontiguousarray(bits.T)]


def from_planes(planes: list[bytes], count: int, dtype: str, unit: str = "byte") -> np.ndarray:
    """The values of a block from its planes."""
    if unit == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=count) for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view(dtype).reshape(count)


class Segment:
    """Writes and reads one segment."""

    @staticmethod
    def pack(header: dict, columns: dict[str, np.ndarray], unit: str = "byte", block: int = BLOCK) -> bytes:
        """Without its end mark, which the writer adds."""
        press = zstandard.ZstdCompressor(level=3)
        body, index, told = [], [], {}
        for name, values in columns.items():
            told[name] = [values.dtype.str, len(values)]
            for at in range(0, len(values), block):
                for plane in to_planes(values[at : at + block], unit):
                    body.append(press.compress(plane))
                    index.append(len(body[-1]))
        chunks = np.array(index, "<u4").tobytes()
        head = json.dumps(
            header | {"columns": told, "unit": unit, "block": block, "body": sum(index), "chunks": len(index)}
        ).encode()
        return b"".join([MAGIC, struct.pack("<I", len(head)), head, *body, chunks])

    @staticmethod
    def unpack(data: memoryview, at: int) -> tuple[dict, dict[str, np.ndarray], int]:
        """Header, columns and the offset of what follows the segment that begins at ``at``."""
        if bytes(data[at : at + 8]) != MAGIC:
            raise ValueError(f"no segment at {at}")
        (size,) = struct.unpack_from("<I", data, at + 8)
        head = json.loads(bytes(data[at + 12 : at + 12 + size]))
        begin = at + 12 + size
        after = begin + head["body"] + 4 * head["chunks"]
        if bytes(data[after : after + 8]) != END:
            raise ValueError(f"the segment at {at} is cut short")
        index = np.frombuffer(data[begin + head["body"] : after], "<u4").astype(np.int64)
        ends = begin + np.cumsum(index)
        press = zstandard.ZstdDecompressor()
        columns, k = {}, 0
        for name, (dtype, count) in head["columns"].items():
            width = np.dtype(dtype).itemsize * (8 if head["unit"] == "bit" else 1)
            blocks = []
            for b in range(0, count, head["block"]):
                planes = [press.decompress(data[ends[i] - index[i] : ends[i]]) for i in range(k, k + width)]
                k += width
                blocks.append(from_planes(planes, min(head["block"], count - b), dtype, head["unit"]))
            columns[name] = np.concatenate(blocks) if blocks else np.zeros(0, dtype)
        return head, columns, after + 8


@lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class ChunkEncoder:
    """Whole texts through the tokenizers library, each distinct word once.

    Right for tokenizers whose words never hold a blank or line feed, that drop white space and case and keep signs
    apart from the letters before them: then a text's ids are those of its chunks between blanks, one after the
    other. Each of these is tried on the file when it is opened; without them texts are encoded whole.

    The chunks of a run of texts are told apart and cut into word and signs by Arrow, and the library sees only words
    that are not kept from earlier runs. All the rest is done for the whole run at once: ids stand one after the
    other in one array, from which those of every chunk are fetched by their places.
    """

    _KEPT = 500_000
    # Letters and digits of Latin-1, whose lower case and composition no tokenizer disputes, then ASCII signs.
    _STEM = r"^(?P<stem>[0-9A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-/:-@\[-`{-~]*)$"
    _WORD = "^[a-zß-öø-ÿ]+$"

    def __init__(self, path: str):
        self._own = _library(path)
        one = self._ids
        probe = "ab, c's\n1 d\n\n e."
        parts = [one(x) for x in probe.replace("\n", " ").split(" ")]
        self.by_chunk = sum(parts, []) == one(probe)
        self.by_stem = all(
            one(stem + tail) == one(stem.lower()) + one(tail) for stem in ("Ab1", "É", "àÖ") for tail in (".", "'", "#*,")
        )
        # Ids that end a word, where the vocabulary marks them: many words are then encoded in one call.
        ends = [i for token, i in self._own.get_vocab().items() if token.endswith("</w>")]
        self._ends = np.zeros(self._own.get_vocab_size(), bool)
        self._ends[ends] = True
        self._forget()

    def _forget(self) -> None:
        """Start over with the empty text alone."""
        self._slots: dict[str, int] = {"": 0}
        self._starts, self._sizes = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self._flat = np.zeros(0, np.uint32)

    def _ids(self, text: str) -> list[int]:
        return self._own.encode(text, add_special_tokens=False).ids

    def _each(self, texts: list[str]) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), 4096):
            for found in self._own.encode_batch_fast(texts[at : at + 4096], add_special_tokens=False):
                yield np.array(found.ids, np.uint32)

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and sizes of words of letters from one call on all of them; None if their ends do not show."""
        joined = [" ".join(words[at : at + 1000]) for at in range(0, len(words), 1000)]
        # A few at a time: what the library returns is far larger than the ids.
        ids = np.concatenate(
            [
                np.array(x.ids, np.uint32)
                for at in range(0, len(joined), 8)
                for x in self._own.encode_batch_fast(joined[at : at + 8], add_special_tokens=False)
            ]
        )
        stops = np.flatnonzero(self._ends[ids]) + 1
        if len(stops) != len(words) or stops[-1] != len(ids):
            return None
        return ids, np.diff(stops, prepend=0)

    def _learn(self, texts: pa.Array) -> None:
        """Keep the encodings of distinct words, signs and other chunks."""
        plain = pc.match_substring_regex(texts, self._WORD)
        words, rest = texts.filter(plain).to_pylist(), texts.filter(pc.invert(plain)).to_pylist()
        found = self._together(words) if words else None
        if found is None:
            words, rest, found = [], words + rest, (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        each = list(self._each(rest))
        sizes = np.concatenate([found[1], np.array([len(x) for x in each], np.int64)])
        begin = len(self._sizes)
        self._slots.update(zip(words + rest, range(begin, begin + len(sizes))))
        self._starts = np.concatenate([self._starts, len(self._flat) + np.cumsum(sizes) - sizes])
        self._sizes = np.concatenate([self._sizes, sizes])
        self._flat = np.concatenate([self._flat, found[0], *each])

    def _kept(self, texts: pa.Array) -> np.ndarray:
        """Slots of distinct texts; those that have none yet get theirs."""
        names, slots = texts.to_pylist(), self._slots
        found = list(map(slots.get, names))
        new = [i for i, slot in enumerate(found) if slot is None]
        if new:
            self._learn(texts.take(pa.array(new)))
            for i in new:
                found[i] = slots[names[i]]
        return np.array(found, np.int64)

    def _encode(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of distinct chunks; those of a stem and signs are put together from both."""
        if not self.by_stem:
            slots = self._kept(chunks)
            return fetched(self._flat, self._starts, self._sizes, slots)
        parts = pc.extract_regex(chunks, self._STEM)
        split = parts.is_valid().to_numpy(zero_copy_only=False)
        both = parts.filter(pa.array(split))
        stems, tails = pc.utf8_lower(pc.struct_field(both, "stem")), pc.struct_field(both, "tail")
        # The empty text stands for the tail of a chunk that is taken whole.
        own = pa.concat_arrays([stems, tails, chunks.filter(pa.array(~split)), pa.array([""])]).dictionary_encode()
        at, n = self._kept(own.dictionary)[own.indices.to_numpy()], len(stems)
        pairs = np.full((len(chunks), 2), at[-1], np.int64)
        pairs[split, 0], pairs[split, 1] = at[:n], at[n : 2 * n]
        pairs[~split, 0] = at[2 * n : -1]
        ids, sizes = fetched(self._flat, self._starts, self._sizes, pairs.ravel())
        return ids, sizes.reshape(-1, 2).sum(axis=1)

    def encode_batch(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as the bytes of 32-bit integers; a null text is an empty one."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        texts = pc.fill_null(texts, "")
        if not self.by_chunk:
            return [found.astype("<u4").tobytes() for found in self._each(texts.to_pylist())]
        if len(self._slots) > self._KEPT:
            self._forget()
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        chunks = lists.flatten().dictionary_encode()
        ids, sizes = self._encode(chunks.dictionary)
        ids, sizes = fetched(ids, np.cumsum(sizes) - sizes, sizes, chunks.indices.to_numpy())
        last = np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
        ends = (4 * np.concatenate([[0], np.cumsum(sizes)])[last]).tolist()
        raw = ids.astype("<u4").tobytes()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]


def fetched(
    ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, places: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Of the encodings that begin at ``starts`` those at ``places``, one after the other, and their sizes."""
    own = sizes[places]
    ends = np.cumsum(own)
    at = np.repeat(starts[places] - (ends - own), own)
    at += np.arange(len(at))
    return ids[at], own


def together(batches: Iterator[pa.RecordBatch], column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in larger ones of about ``limit`` bytes of text in ``column``."""
    held, size = [], 0
    for piece in in_slices(batches, column, limit):
        if held and size + piece.column(column).nbytes > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(piece)
        size += piece.column(column).nbytes
    if held:
        yield pa.concat_batches(held)


@lru_cache(maxsize=2)
def _chunks(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def write_ids(
    df: DataFrame,
    folder: str,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int | None = 2,
    unit: str = "byte",
    files: int | None = None,
) -> None:
    """Encode every whole text and write its ids to ``folder`` in ascending order of ``key``.

    A null text is an empty one; with ``end_id`` each document ends in it, so even an empty document
    has an id. Null keys come first, rows of one key in the order of their text (nulls first).
    An empty table gives a folder without segments. Other columns are not looked at. ``files`` is the
    number of ranges, by default as many as the session's shuffle has; each is written to one or more files.
    A range ends at a key or, so that a frequent key is spread, between texts of it that differ in their first
    ``PREFIX`` characters.
    """
    spark = df.sparkSession
    ship_package(spark)
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The text is dealt out as it is: sampling for the ranges then reads the table, not its encoding.
    sorted_rows = (
        df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
        .repartitionByRange(files, F.col("key"), F.substring("text", 1, PREFIX))
        .sortWithinPartitions("key", "text")
        .withColumn("part", F.spark_partition_id())
    )

    def step(batches):
        own = _chunks(path)
        tail = np.array([] if end_id is None else [end_id], "<u4").tobytes()
        keys, known, counts, more, held, size, part, n_rows = [], [], [], [], [], 0, 0, 0

        def closed() -> bytes:
            columns = {
                "ids": np.frombuffer(b"".join(held), "<u4"),
                "keys": np.array(keys, "<i8"),
                "known": np.array(known, "<u1"),
                "counts": np.array(counts, "<u4"),
                "more": np.array(more, "<u1"),
            }
            segment = Segment.pack({"part": part, "row": n_rows}, columns, unit)
            for kept in (keys, known, counts, more, held):
                kept.clear()
            return segment

        def row(segments: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([END.join(segments)], pa.binary())], ["value"])

        for batch in together(batches, 1):
            part = batch.column(2)[0].as_py()
            for k, found in zip(batch.column(0).to_pylist(), own.encode_batch(batch.column(1))):
                found += tail
                # Rows, and so files, begin with a document.
                if size and size + len(found) // 4 > SEGMENT:
                    yield row([closed()])
                    size, n_rows = 0, n_rows + 1
                begin, full = 0, []
                while True:
                    take = found[begin : begin + 4 * SEGMENT]
                    begin += len(take)
                    keys.append(k or 0)
                    known.append(k is not None)
                    counts.append(len(take) // 4)
                    more.append(begin < len(found))
                    held.append(take)
                    size += len(take) // 4
                    if begin >= len(found):
                        break
                    full.append(closed())
                if full:
                    yield row([*full, closed()])
                    size, n_rows = 0, n_rows + 1
        if keys:
            yield row([closed()])

    (
        sorted_rows.mapInArrow(step, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", END.decode("latin-1"))
        .option("maxRecordsPerFile", FILE_ROWS)
        .text(folder)
    )


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files in ``folder``: part (its file, in the order of the rows), place (in its
    file), key, start (ids of the file before it), n_tokens, ids_crc32 and, if asked for, ids (array of long).

    A file is read by one task, segment after segment. A damaged file raises ``ValueError``.
    """
    ship_package(spark)
    schema = "part long, place long, key long, start long, n_tokens long, ids_crc32 long"
    if with_ids:
        schema += ", ids array<long>"
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def documents(data: memoryview) -> Iterator[tuple]:
        at = start = place = tokens = crc = 0
        part, held = None, []
        while at < len(data):
            head, columns, at = Segment.unpack(data, at)
            raw = columns["ids"].astype("<u4")
            if part is None:
                part = (head["part"] << 32) + head["row"]
            begin = 0
            for k, known, count, goes_on in zip(
                columns["keys"].tolist(), columns["known"].tolist(), columns["counts"].tolist(), columns["more"].tolist()
            ):
                ids = raw[begin : begin + count]
                begin += count
                tokens += count
                crc = zlib.crc32(ids, crc)
                if with_ids:
                    held += ids.tolist()
                if goes_on:
                    continue
                yield (part, place, k if known else None, start, tokens, crc, held)
                start, place = start + tokens, place + 1
                tokens, crc, held = 0, 0, []

    def step(batches):
        types = [*[pa.int64()] * 6, pa.list_(pa.int64())]
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for row in documents(memoryview(content.as_buffer())):
                    rows.append(row)
                    if len(rows) == (500 if with_ids else 20_000):
                        yield packed(rows, types)
                        rows = []
                if rows:
                    yield packed(rows, types)

    def packed(rows, types) -> pa.RecordBatch:
        columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)][: len(names)]
        return pa.RecordBatch.from_arrays(columns, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(step, schema)


def with_starts(documents: DataFrame) -> DataFrame:
    """Turn the starts within each file into starts within all files.

    The files of one range of keys are summed up by a window, however many they are; the driver gets a row for each
    range, of which there are as many as the writer's shuffle had partitions.
    """
    sums = documents.groupBy("part").agg(F.sum("n_tokens").alias("_sum")).withColumn("_range", F.shiftright("part", 32))
    before, at = [], 0
    for row in sums.groupBy("_range").agg(F.sum("_sum").alias("tokens")).sort("_range").collect():
        before.append((row["_range"], at))
        at += row["tokens"]
    if not before:
        return documents
    ranges = documents.sparkSession.createDataFrame(before, "_range long, _first long")
    earlier = Window.partitionBy("_range").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    bases = files.join(ranges, "_range").select("part", (F.col("_before") + F.col("_first")).alias("_base"))
    joined = documents.join(bases, "part")
    return joined.withColumn("start", F.col("start") + F.col("_base")).drop("_base")
