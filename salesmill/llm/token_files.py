"""Token ids in binary files of Simple-8b words.

A file holds the documents of one range of ids, in ascending order:

    magic | documents, ids, words, blocks (4 x u64)
    document ids (i64 each) | 1 where the document id is null (u8 each)
    ids in each document (u64 each) | first word of each block (u64 each) | words (u64 each)

all little-endian. Files are written by the task that holds the range, under another name
first and moved when complete, so a task that runs again replaces a file by an equal one.
They are read back through Spark's ``binaryFile`` source, file by file.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import simple8b
from .common import scratch_folder, slices, stage

MAGIC = b"S8TOKENS"
END_ID = 2
IDS_IN_FILE = 1_000_000
CACHE_BYTES = 64 << 20
PIECES_AT_ONCE = 5_000   # a text of that many lines still fits the processor's caches
WORDS_AT_ONCE = 500_000
BATCH_BYTES = 10 << 20
RANGE_BYTES = 96 << 20   # of text for a task: fewer, longer ranges repeat fewer pieces


class PieceCache:
    """Ids of texts from a ``tokenizers`` tokenizer, each distinct piece encoded once while it is known.

    A byte-level pre-tokenizer never joins a space to a visible character before it, so texts are cut
    before such spaces; only the distinct words of a batch are looked up and their ids laid out again in the
    order of the texts. Words of Latin letters are cut on at changes between letters,
    digits, signs and white space, as the pre-tokenizer does. Texts with other spaces or with one of the
    tokenizer's added tokens are encoded whole, and tokenizers of another kind encode whole texts only.
    All of that is done in Arrow: no word or piece is a Python object.

    What is known is kept in two generations of about ``CACHE_BYTES`` together: words and pieces met again move to the
    young one, and when that is full the old one is forgotten. That bounds memory and changes no result.
    """

    LATIN = r"\A[\t\n\r -~À-ÖØ-öø-ÿ]*\z"
    # Between words' pieces; no Latin word has it.
    CUT = "\0"
    # The cuts of byte-level pre-tokenizers, for the characters of LATIN: of white space before something
    # visible the last character is a piece of its own.
    LAST_SPACE = r"(\s)(\s\S)"
    PIECE = r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ\x00]+|\s+"
    # Pieces that stay pieces in a line of their own: no contraction begins without its mark.
    LINE = r"\A ?(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]+)\z"
    # A space after other white space (of any kind) may belong to it.
    LOOSE_SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}] "

    def __init__(self, tokenizer, cache_bytes: int = CACHE_BYTES) -> None:
        self.tokenizer = tokenizer
        kind = json.loads(tokenizer.to_str())
        first = kind["pre_tokenizer"] or {}
        self.cuttable = kind["normalizer"] is None and (
            first.get("type"), first.get("add_prefix_space"), first.get("use_regex")
        ) == ("ByteLevel", False, True)
        added = [t["content"] for t in kind.get("added_tokens") or []]
        self.whole = "|".join([self.LOOSE_SPACE, *map(re.escape, added)])
        self.most = cache_bytes // 2
        # Texts, all different, and the ids of each.
        self.young = self.old = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.held = 0
        line = tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None

    def _encode(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _encode_each(self, pieces: pa.Array) -> pa.Array:
        return pa.array(self._encode(pieces.to_pylist()), pa.large_binary())

    def _encode_lines(self, pieces: pa.Array) -> pa.Array:
        """Words and numbers are encoded as lines of one text: a call for each costs more than its ids."""
        rows = pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces)
        text = pc.binary_join(rows, pa.scalar("\n", pieces.type))[0].as_py()
        ids = np.frombuffer(self._encode([text])[0], "<u4")
        ends = np.flatnonzero(ids == self.line)
        if len(ends) != len(pieces) - 1:
            return self._encode_each(pieces)
        laid = ids[ids != self.line]
        bounds = 4 * np.concatenate(([0], ends - np.arange(len(ends)), [len(laid)])).astype(np.int64)
        return _binaries(bounds, pa.py_buffer(laid.tobytes()))

    def _add(self, texts: pa.Array, ids: pa.Array) -> np.ndarray:
        """The places that these texts get in the young generation."""
        known = len(self.young[0])
        self.young = tuple(pa.concat_arrays(pair) for pair in zip(self.young, (texts, ids)))
        self.held = sum(part.nbytes for part in self.young)
        return np.arange(known, known + len(texts))

    def _known(self, texts: pa.Array) -> np.ndarray:
        """The places of these different texts in the young generation; -1 where they are not known."""
        at = _places(texts, self.young[0])
        missing = np.flatnonzero(at < 0)
        back = _places(texts.take(pa.array(missing)), self.old[0])
        found = missing[back >= 0]
        at[found] = self._add(texts.take(pa.array(found)), self.old[1].take(pa.array(back[back >= 0])))
        return at

    def _learn(self, pieces: pa.Array) -> np.ndarray:
        """The places of these different pieces, which are encoded where they are not known."""
        at = self._known(pieces)
        new = np.flatnonzero(at < 0)
        some = pieces.take(pa.array(new))
        is_line = _mask(pc.match_substring_regex(some, self.LINE)) & (self.line is not None)
        order, texts, ids = [], [], []
        for chosen, encode in ((is_line, self._encode_lines), (~is_line, self._encode_each)):
            rows = np.flatnonzero(chosen)
            for start in range(0, len(rows), PIECES_AT_ONCE):
                order.append(rows[start:start + PIECES_AT_ONCE])
                texts.append(some.take(pa.array(order[-1])))
                ids.append(encode(texts[-1]))
        if order:
            at[new[np.concatenate(order)]] = self._add(pa.concat_arrays(texts), pa.concat_arrays(ids))
        return at

    def _cut(self, words: pa.Array, latin: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Pieces of words, Latin ones first; the words in that order, and where the pieces of each begin and end."""
        order = np.concatenate((np.flatnonzero(latin), np.flatnonzero(~latin)))
        spaced = pc.replace_substring_regex(words.filter(pa.array(latin)), self.LAST_SPACE, rf"\1{self.CUT}\2")
        # An empty piece, which has no ids, is after the last one.
        cut = pc.split_pattern(pc.replace_substring_regex(spaced, self.PIECE, rf"\0{self.CUT}"), self.CUT)
        ends = cut.offsets.to_numpy().astype(np.int64)
        pieces = pa.concat_arrays([cut.flatten(), words.filter(pa.array(~latin))])
        return pieces, order, np.concatenate((ends, ends[-1] + 1 + np.arange(len(words) - len(ends) + 1)))

    def _ids_of(self, words: pa.Array) -> pa.Array:
        """Ids of different words."""
        at = self._known(words)
        new = np.flatnonzero(at < 0)
        if len(new):
            some = words.take(pa.array(new))
            pieces, order, bounds = self._cut(some, _mask(pc.match_substring_regex(some, self.LATIN)))
            new, some = new[order], some.take(pa.array(order))
            pieces = pieces.dictionary_encode()
            place = self._learn(pieces.dictionary)[pieces.indices.to_numpy()]
            laid = self.young[1].take(pa.array(place))
            joined = _binaries(_ends(laid)[bounds], laid.buffers()[2])
            first = pieces.dictionary.take(pieces.indices.take(pa.array(bounds[:-1])))
            alone = pc.equal(first, some)
            is_alone = _mask(alone)
            at[new[is_alone]] = place[bounds[:-1]][is_alone]
            several = pc.invert(alone)
            at[new[~is_alone]] = self._add(some.filter(several), joined.filter(several))
        return self.young[1].take(pa.array(at))

    def __call__(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit numbers."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.fill_null("")
        if not self.cuttable:
            yield from self._encode(texts.to_pylist())
            return
        whole = pc.match_substring_regex(texts, self.whole)
        cut = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        # The first word of a text has no space before it.
        bounds = cut.offsets.to_numpy().astype(np.int64) - cut.offsets[0].as_py()
        words = cut.flatten().dictionary_encode()
        del cut
        at = words.indices.to_numpy()
        firsts, first = np.unique(at[bounds[:-1]], return_inverse=True)
        at = at + np.int32(len(firsts))
        at[bounds[:-1]] = first
        known = words.dictionary.cast(pa.large_string())
        del words
        nothing, space = (pa.scalar(x, known.type) for x in ("", " "))
        distinct = pa.concat_arrays([known.take(pa.array(firsts)), pc.binary_join_element_wise(nothing, known, space)])
        del known
        ids = []
        for start in range(0, len(distinct), WORDS_AT_ONCE):
            if self.held > self.most:
                self.young, self.old = tuple(part[:0] for part in self.young), self.young
                self.held = 0
            ids.append(self._ids_of(distinct.slice(start, WORDS_AT_ONCE)))
        if not ids:
            return
        del distinct
        laid = pa.concat_arrays(ids).take(pa.array(at))
        del ids, at
        ends = _ends(laid)[bounds].tolist()
        data = memoryview(laid.buffers()[2] or b"")
        for k, is_whole in enumerate(whole.to_pylist()):
            yield self._encode([texts[k].as_py()])[0] if is_whole else bytes(data[ends[k]:ends[k + 1]])


def _mask(flags: pa.Array) -> np.ndarray:
    return flags.to_numpy(zero_copy_only=False).astype(bool)


def _places(texts: pa.Array, among: pa.Array) -> np.ndarray:
    """Where each of different texts is among others, -1 if it is not: the hash table is of the former, mostly the fewer."""
    at = np.full(len(texts), -1)
    found = pc.index_in(among, value_set=texts)
    at[found.drop_null().to_numpy()] = np.flatnonzero(_mask(found.is_valid()))
    return at


def _ends(values: pa.Array) -> np.ndarray:
    """Where large binaries begin and end in their buffer."""
    return np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]


def _binaries(bounds: np.ndarray, data: pa.Buffer | None) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.tobytes()), data])


@lru_cache(maxsize=1)
def _cache(tokenizer_file: str, size: int, changed: int) -> PieceCache:
    from tokenizers import Tokenizer

    return PieceCache(Tokenizer.from_file(tokenizer_file))


def cache_of(tokenizer_file: str) -> PieceCache:
    """The pieces of a file's tokenizer, made once in a worker process: its tasks share what is known, within its
    bounds. A tokenizer for each task would leave some MB behind every time."""
    found = os.stat(tokenizer_file)
    return _cache(tokenizer_file, found.st_size, found.st_mtime_ns)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, as Spark resolves it, in the form that ``pyarrow.fs`` reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^file:/(?!/)", "file:///", found)


def file_bytes(doc_ids: list[int | None], encoded: list[bytes]) -> bytes:
    ids = np.frombuffer(b"".join(encoded), "<u4")
    words, starts = simple8b.pack(ids)
    head = np.array([len(doc_ids), len(ids), len(words), len(starts)], "<u8")
    return b"".join([
        MAGIC,
        head.tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.array([len(e) // 4 for e in encoded], "<u8").tobytes(),
        starts.astype("<u8").tobytes(),
        words.astype("<u8").tobytes(),
    ])


def parse_file(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, ids in each document, and all ids."""
    if content[:8] != MAGIC:
        raise ValueError("not a file of token ids")
    docs, total, n_words, blocks = (int(x) for x in np.frombuffer(content, "<u8", 4, 8))
    at = 40
    doc_ids = np.frombuffer(content, "<i8", docs, at)
    missing = np.frombuffer(content, np.uint8, docs, at := at + 8 * docs)
    lengths = np.frombuffer(content, "<u8", docs, at := at + docs)
    starts = np.frombuffer(content, "<u8", blocks, at := at + 8 * docs)
    words = np.frombuffer(content, "<u8", n_words, at + 8 * blocks)
    ids = simple8b.unpack(words, starts, total)
    return [None if m else int(d) for d, m in zip(doc_ids, missing)], lengths.astype(np.int64), ids


def write_token_files(docs: DataFrame, tokenizer_file: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Encode ``doc_id, text`` of all documents and write their ids below ``folder``, in
    ascending order of doc_id (null first; equal ids by the hash of their texts).

    Returns the written manifest: ``file, n_docs, n_ids``. A null or empty text has the end
    id alone. Texts count whole, and a special token in them is what the library makes of
    it. No documents: no files. Repeated rows are written as often as they come. Other columns are not read.

    ``folder`` must be one that ``pyarrow.fs`` can write to and Spark can read. Without a scheme it is
    on the file system that Spark takes it for.
    """
    place = qualified(docs.sparkSession, folder)

    def encode_range(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = cache_of(tokenizer_file)
        store, root = pa.fs.FileSystem.from_uri(place)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        end = np.array([end_id], "<u4").tobytes()
        doc_ids, encoded, held, written = [], [], 0, []

        def flush() -> None:
            name = f"ids-{task.partitionId():08d}-{len(written):06d}.s8"
            draft = f"{root}/_draft-{task.taskAttemptId()}-{name}"
            with store.open_output_stream(draft) as out:
                out.write(file_bytes(doc_ids, encoded))
            store.move(draft, f"{root}/{name}")
            written.append((name, len(doc_ids), held))

        gc.disable()   # it would walk through millions of strings, again and again, and there are no cycles
        for batch in slices(batches, "text", BATCH_BYTES):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                doc_ids.append(doc_id)
                encoded.append(ids + end)
                held += len(ids) // 4 + 1
                if held >= IDS_IN_FILE:
                    flush()
                    doc_ids, encoded, held = [], [], 0
        if doc_ids:
            flush()
        gc.enable()
        names, counts, totals = zip(*written) if written else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(totals, pa.int64())],
            ["file", "n_docs", "n_ids"],
        )

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // RANGE_BYTES))
    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange(ranges, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    return stage(ordered.mapInArrow(encode_range, "file string, n_docs bigint, n_ids bigint"), "token-manifest")


def read_token_files(
    spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = True
) -> DataFrame:
    """Per document: ``doc_id, start`` (ids of all documents before it), ``n_tokens,
    ids_crc32`` and, if asked for, the ``ids`` themselves.

    Raises if a file of the manifest is not there or holds another number of documents. What orders
    the files is a window over one row for each, of a million ids.
    """
    names = ["file", "docs_in_file", "doc_id", "offset", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    layout = "file string, docs_in_file bigint, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint"

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                doc_ids, lengths, ids = parse_file(content.as_py())
                ends = np.cumsum(lengths)
                raw = memoryview(ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                columns = [
                    pa.array([path.rsplit("/", 1)[1]] * len(doc_ids), pa.string()),
                    pa.array([len(doc_ids)] * len(doc_ids), pa.int64()),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ]
                if with_ids:
                    offsets = pa.array(np.append(0, ends), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names)

    before = F.coalesce(
        F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    starts = manifest.select("file", "n_docs", before.alias("file_start"))
    files = spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary"
    ).option("pathGlobFilter", "*.s8").load(folder)
    decoded = files.select("path", "content").mapInArrow(decode, layout + ", ids array<bigint>" * with_ids)
    lost = F.raise_error(F.concat(F.lit("token file is not as written: "), "file")).cast("bigint")
    whole = F.coalesce(F.col("docs_in_file") == F.col("n_docs"), F.lit(False))
    return starts.join(decoded, "file", "left").select(
        "doc_id",
        F.when(whole, F.col("file_start") + F.col("offset")).otherwise(lost).alias("start"),
        *names[4:],
    )


def token_digest(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Write the files to the shared scratch folder and read their digest back."""
    spark = docs.sparkSession
    folder = scratch_folder(spark, "token-files")
    manifest = write_token_files(docs, tokenizer_file, folder)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return read_token_files(spark, folder, manifest, with_ids=False)
