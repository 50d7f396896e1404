"""Token ids in seekable zstandard files: one independent frame per document, a trailing seek table, checksums.

File layout (the public "zstd seekable" layout plus one skippable frame):

* frames 0..n-1: the ids of one document each, little-endian unsigned 32-bit, ended by the end id; every frame
  carries zstandard's own content checksum;
* a skippable frame (magic 0x184D2A50) with one record per document: a flag byte (1: the id is null) and the
  document id as a little-endian signed 64-bit integer;
* a skippable frame (magic 0x184D2A5E), the seek table: per frame compressed size, decompressed size and the low 32
  bits of the XXH64 of the decompressed bytes; then the number of frames, a descriptor byte and magic 0x8F92EAB1.

A reader takes the two tables from the end of the file, then reads and decompresses only the frames it wants.

Defined results: a null text is an empty one (only the end id); a null ``doc_id`` is kept and sorts first; rows that
repeat a ``doc_id`` are all kept, ordered by text; an empty table gives no file and no row; only the id and text
columns are read, so further columns of any name do no harm; a text of any length is one frame.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from caseweave.llm.byte_bpe import slices
from caseweave.llm.files import READERS, AttemptFile, apart, open_file
from caseweave.llm.memo import Memo
from caseweave.session import scratch_path, stored

DOC_FRAME, SEEK_FRAME, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
ENTRY, DOC, ENTRY_BYTES, DOC_BYTES = "<III", "<Bq", 12, 9
FILE_BYTES = 32 << 20
MEMO_WORDS, MEMO_LENGTH = 900_000, 48

# Latin letters, then ASCII marks that no special token begins with.
PLAIN = r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:;=-@\[-`{-~]*)"

MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"
INDEX = "doc_id long, path string, frame int, offset long, size long, raw_size long, checksum long"


class WordEncoder:
    """The library's encoding of whole texts by way of their words.

    The tokenizer splits at white space and drops it, so a text's ids are the ids of its words in turn. Each word goes
    through the library; a bounded memo keeps the ids of short words. ASCII white space is split here, any other white
    space stays inside a "word" for the library. Words of plain letters with marks behind go to the library's model
    directly, after a check that its steps before the model do to them what is done here.
    """

    _loaded: dict[str, WordEncoder] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.memo = Memo(self._words, MEMO_WORDS, MEMO_LENGTH)
        self.model, self.pieces = self.tokenizer.model, {}
        self.model._resize_cache(0)  # the memos hold what the library's own cache would
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.mapped = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.plain = self._plain_words()

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """The worker's own instance, kept for its next tasks."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _words(self, words: list[bytes]) -> list[bytes]:
        out, rest, ascii_plain = [b""] * len(words), [], self.plain is not None
        known = self.pieces.get  # no piece has no ids
        for i, word in enumerate(words):
            if ascii_plain and word.isalpha():  # ASCII letters only
                out[i] = known(piece := word.lower().decode()) or self._piece(piece, False)
                continue
            found = self.plain and self.plain.fullmatch(text := word.decode())
            if found:
                letters, marks = found.groups()
                own = known(piece := letters.lower()) or self._piece(piece)
                out[i] = own + (known(marks) or self._piece(marks)) if marks else own
            else:
                rest.append(i)
        encoded = self.tokenizer.encode_batch_fast([words[i].decode() for i in rest], add_special_tokens=False)
        for i, own in zip(rest, encoded, strict=True):
            out[i] = struct.pack(f"<{len(own.ids)}I", *own.ids)
        return out

    def _piece(self, piece: str, accented: bool = True) -> bytes:
        """Ids of one pre-token, by the library's model itself."""
        known = self.pieces.get(piece)
        if known is None:
            ids = [token.id for token in self.model.tokenize(piece.translate(self.mapped) if accented else piece)]
            known = struct.pack(f"<{len(ids)}I", *ids)
            if len(self.pieces) >= MEMO_WORDS:
                self.pieces.clear()
            if len(piece) <= MEMO_LENGTH:
                self.pieces[piece] = known
        return known

    def _plain_words(self) -> re.Pattern | None:
        """Words for which the library's steps before its model are known: lower case, letters and marks apart.

        The tokenizer is asked whether that is so; None where it is not.
        """
        pattern = re.compile(PLAIN)
        for probe in ("Ab", "\u00c9a\u00df", "\u00ffB,", "a!?", "z***", "Q\"", "\u00f1%%%", "o.,"):
            letters, marks = pattern.fullmatch(probe).groups()
            ids = [t.id for x in (letters.lower(), marks) if x for t in self.model.tokenize(x.translate(self.mapped))]
            if ids != self.tokenizer.encode(probe, add_special_tokens=False).ids:
                return None
        return pattern

    def __call__(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, without an end id.

        The memo is asked once per distinct word of ``texts``; the ids of the words in turn are then taken from an array.
        """
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten().dictionary_encode()
        packed = self.memo.each(words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
        taken = pa.array(packed, pa.large_binary()).take(words.indices)
        _, offsets, data = taken.buffers()
        # Where each text's ids end: behind those of its last word.
        ends = np.frombuffer(offsets, np.int64)[np.cumsum(np.asarray(lists.value_lengths()))].tolist() if len(taken) else [0] * len(texts)
        data = memoryview(data or b"")
        return [bytes(data[start:stop]) for start, stop in zip([0, *ends], ends)]


class FrameWriter:
    """One file of the layout above."""

    def __init__(self, folder: str, stem: str, level: int):
        self.file = AttemptFile(folder, stem, ".ids.zst")
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.entries, self.docs, self.n_tokens = [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.compressor.compress(ids)
        self.file.write(frame)
        self.entries.append(struct.pack(ENTRY, len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.docs.append(struct.pack(DOC, doc_id is None, doc_id or 0))
        self.n_tokens += len(ids) // 4

    def close(self) -> None:
        docs, table = b"".join(self.docs), b"".join(self.entries)
        footer = struct.pack("<IBI", len(self.entries), 0x80, SEEKABLE)
        self.file.write(struct.pack("<II", DOC_FRAME, len(docs)) + docs)
        self.file.write(struct.pack("<II", SEEK_FRAME, len(table) + len(footer)) + table + footer)
        self.file.close()


def tables_of(source) -> list[tuple[int | None, int, int, int, int]]:
    """(doc_id, offset, compressed size, decompressed size, checksum) of each frame, from the end of the file."""
    size = source.size()
    source.seek(size - 9)
    n, descriptor, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE or not descriptor & 0x80:
        raise ValueError("not a seekable file with checksums")
    length = n * ENTRY_BYTES + 9
    source.seek(size - length - 8)
    if struct.unpack("<II", source.read(8)) != (SEEK_FRAME, length):
        raise ValueError("the seek table is damaged")
    table = source.read(n * ENTRY_BYTES)
    source.seek(size - length - 8 - n * DOC_BYTES - 8)
    if struct.unpack("<II", source.read(8)) != (DOC_FRAME, n * DOC_BYTES):
        raise ValueError("the table of documents is damaged")
    docs = source.read(n * DOC_BYTES)
    found, offset = [], 0
    for (packed, raw, check), (null, doc_id) in zip(struct.iter_unpack(ENTRY, table), struct.iter_unpack(DOC, docs), strict=True):
        found.append((None if null else doc_id, offset, packed, raw, check))
        offset += packed
    return found


def frame_at(source, offset: int, size: int, raw_size: int, check: int, decompressor) -> bytes:
    """One frame's ids, after both checksums."""
    source.seek(offset)
    ids = decompressor.decompress(source.read(size), max_output_size=raw_size)
    if len(ids) != raw_size or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != check:
        raise ValueError(f"the frame at {offset} fails its checksum")
    return ids


def write(
    docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", level: int = 3
) -> DataFrame:
    """Encode and write all documents in ascending id order; the manifest has a row per file, in that order by
    (part, seq). Files of failed attempts have names of their own and no row in the manifest."""
    folder = scratch_path(docs.sparkSession, "token-frames")
    end = struct.pack("<I", end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, rows, writer = WordEncoder.of(tokenizer), TaskContext.get().partitionId(), [], None

        def finish() -> None:
            writer.close()
            rows.append((part, len(rows), writer.file.path, len(writer.docs), writer.n_tokens))

        for batch in batches:
            for at, stop in slices(pc.binary_length(batch.column(1)).fill_null(0).to_pylist()):
                piece = batch.slice(at, stop - at)
                encoded = encoder(piece.column(1))
                for doc_id, ids in zip(piece.column(0).to_pylist(), encoded, strict=True):
                    writer = writer or FrameWriter(folder, f"part-{part:05d}-{len(rows):04d}", level)
                    writer.add(doc_id, ids + end)
                    if writer.file.size >= FILE_BYTES:
                        finish()
                        writer = None
        if writer:
            finish()
        if rows:
            names = ("part", "seq", "path", "n_docs", "n_tokens")
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
            )

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return stored(ordered.mapInArrow(encode, MANIFEST), "token-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Every document of the files: ``start`` (ids before it in the whole collection), ``n_tokens``, ``ids_crc32``.

    A file is read by one task, and up to ``READERS`` tasks share the files.
    """
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                with open_file(path) as source:
                    for doc_id, offset, size, raw, check in tables_of(source):
                        ids = frame_at(source, offset, size, raw, check, decompressor)
                        rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
                        start += len(ids) // 4
                names = ("doc_id", "start", "n_tokens", "ids_crc32")
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

    return apart(files).mapInArrow(scan, DOCUMENTS)


def index(manifest: DataFrame) -> DataFrame:
    """Where each document's frame lies, from the tables at the files' ends; no frame is read."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_file(path) as source:
                    rows = [(d, path, i, o, s, r, c) for i, (d, o, s, r, c) in enumerate(tables_of(source))]
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("doc_id", "path", "frame", "offset", "size", "raw_size", "checksum"), r, strict=True)) for r in rows],
                    schema=pa.schema([("doc_id", pa.int64()), ("path", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()),
                                      ("size", pa.int64()), ("raw_size", pa.int64()), ("checksum", pa.int64())]),
                )

    return apart(manifest.select("path")).mapInArrow(scan, INDEX)


def fetch(located: DataFrame) -> DataFrame:
    """The ids of the documents whose rows of :func:`index` are given; only their frames are decompressed."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor, path, source = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path:
                    path, source = row["path"], open_file(row["path"])
                ids = frame_at(source, row["offset"], row["size"], row["raw_size"], row["checksum"], decompressor)
                values = pa.array(struct.unpack(f"<{len(ids) // 4}I", ids), pa.int64())
                lists = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                yield pa.RecordBatch.from_arrays([pa.array([row["doc_id"]], pa.int64()), lists], ["doc_id", "ids"])

    stretch = F.expr("frame div 4096")
    n = located.select("path", stretch).distinct().count()
    ordered = located.repartition(max(1, min(n, READERS)), "path", stretch).sortWithinPartitions("path", "offset")
    return ordered.mapInArrow(take, "doc_id long, ids array<long>")
