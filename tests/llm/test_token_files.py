import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql.types import _parse_datatype_string
from tokenizers import Tokenizer

from caseweave.llm import byte_bpe, frames
from caseweave.llm.memo import Memo
from tests.llm.fixtures import awkward, clashing, documents

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def test_files_hold_what_the_library_encodes(spark, tokenizer):
    manifest = frames.write(clashing(documents(spark)), WORDS)
    rows = sorted(frames.read(manifest).collect(), key=lambda r: r["start"])
    expected, start = [], 0
    for doc_id, text in sorted(((r[0], r[1]) for r in awkward()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        expected.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert [tuple(r) for r in rows] == expected


def test_one_document_is_read_from_its_frame(spark, tokenizer):
    manifest = frames.write(documents(spark), WORDS)
    wanted = frames.index(manifest).where("doc_id IN (3, 11)")
    found = {r["doc_id"]: r["ids"] for r in frames.fetch(wanted).collect()}
    texts = {r[0]: r[1] for r in awkward()}
    assert found == {i: tokenizer.encode(texts[i], add_special_tokens=False).ids + [1] for i in (3, 11)}


def test_damaged_frame_is_noticed(spark):
    manifest = frames.write(documents(spark), WORDS)
    row = frames.index(manifest).where("doc_id = 10").first()
    path = row["path"].removeprefix("file:")
    with open(path, "r+b") as file:
        file.seek(row["offset"] + row["size"] // 2)
        byte = file.read(1)
        file.seek(-1, 1)
        file.write(bytes([byte[0] ^ 255]))
    with pytest.raises(Exception, match="checksum|Zstd|decompress"):
        frames.read(manifest).collect()


def test_files_of_an_empty_table(spark):
    assert frames.read(frames.write(documents(spark, []), WORDS)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_words_encode_like_whole_texts(texts):
    whole = Tokenizer.from_file(WORDS) if not hasattr(frames, "_whole") else frames._whole
    frames._whole = whole
    got = frames.WordEncoder.of(WORDS)(texts)
    assert [list(struct.unpack(f"<{len(g) // 4}I", g)) for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_each_distinct_word_of_a_slice_is_asked_once(monkeypatch):
    encoder, asked = frames.WordEncoder.of(WORDS), []
    monkeypatch.setattr(encoder.memo, "each", lambda keys, each=encoder.memo.each: asked.append(len(keys)) or each(keys))
    texts = pa.array(["skipped", "one two  one\n", None, "", "two one\x1cx", " "])[1:]
    got = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
    assert [np.frombuffer(g, "<u4").tolist() for g in encoder(texts)] == got
    assert asked == [4]  # one, two, one\x1cx and the empty word at the ends


def test_byte_bpe_equals_the_library_and_decodes(spark, tiktoken_encoding):
    df = clashing(documents(spark)).drop("ids")
    encoded = byte_bpe.with_ids(df, RANKS, public_tokenizers.PATTERN)
    rows = byte_bpe.with_bytes(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(awkward())
    for row in rows:
        assert row["ids"] == tiktoken_encoding.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]) == (row["text"] or "").encode()


def test_byte_bpe_of_an_empty_table(spark):
    assert byte_bpe.with_ids(documents(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_byte_bpe_of_any_text(tiktoken_encoding, text):
    bpe = byte_bpe.Bpe.of(RANKS, public_tokenizers.PATTERN)
    ids = np.frombuffer(bpe.encode([text])[0], "<u4").tolist()
    assert ids == tiktoken_encoding.encode_ordinary(text) and bpe.decode(pa.array([ids], pa.list_(pa.int32()))).to_pylist() == [text.encode()]


def test_perfect_hash_is_minimal():
    hashes = np.random.default_rng(0).integers(0, 2**63, 5000, dtype=np.uint64)
    assert sorted(byte_bpe.PerfectHash(hashes)(hashes).tolist()) == list(range(5000))


def test_memo_keeps_frequent_keys():
    asked = []
    memo = Memo(lambda keys: asked.extend(keys) or [k.encode() for k in keys], entries=2, length=3)
    for rows in ([["a", "b", "c"]], [["a", "long one"]], [["d", "a"]], [["a", "long one"], []]):
        assert memo.joined(rows) == ["".join(r).encode() for r in rows]
    assert asked.count("a") == 1 and asked.count("long one") == 2


class InProcess:
    """Stands in for a DataFrame: what it is to run in tasks is returned."""

    def __init__(self, ddl):
        self.schema = _parse_datatype_string(ddl)
        self.columns = self.schema.names

    def mapInArrow(self, run, schema):
        return run


def test_worker_without_lasting_memos_holds_none_between_tasks(monkeypatch):
    monkeypatch.setattr(byte_bpe.Bpe, "_loaded", {})
    texts = ["zzqx vvkw naïve", None, "", "a plain text", "vvkw "]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(5)), "text": pa.array(texts)})
    docs, found = InProcess("doc_id long, text string"), {}
    for lasting in (True, False):
        encode = byte_bpe.with_ids(docs, RANKS, public_tokenizers.PATTERN, lasting=lasting)
        found[lasting] = [out.column(2).to_pylist() for out in encode(iter([batch, batch]))]
        bpe = byte_bpe.Bpe.of(RANKS, public_tokenizers.PATTERN)
        assert bool(bpe.memo.known) == bool(bpe.pieces.known) == lasting
    assert found[True] == found[False]


def test_decoding_loads_no_encoder(monkeypatch):
    monkeypatch.setattr(byte_bpe.Bpe, "_loaded", {})
    ids = byte_bpe.Bpe(RANKS, public_tokenizers.PATTERN).encode(["vvkw naïve"])[0]
    batch = pa.RecordBatch.from_pydict({"ids": pa.array([np.frombuffer(ids, "<i4").tolist(), None], pa.list_(pa.int32()))})
    decode = byte_bpe.with_bytes(InProcess("ids array<int>"), RANKS, public_tokenizers.PATTERN)
    assert [out.column(1).to_pylist() for out in decode(iter([batch]))] == [["vvkw naïve".encode(), b""]]
    assert not byte_bpe.Bpe._loaded


def test_short_pieces_are_merged_without_a_heap(monkeypatch):
    ranks, rng = byte_bpe.read_ranks(RANKS), np.random.default_rng(3)
    pieces = [bytes(rng.choice(list(b" aeinrst\xc3\xa9"), rng.integers(1, byte_bpe.SHORT + 1)).tolist()) for _ in range(300)]
    short = [byte_bpe.merge(piece, ranks) for piece in pieces]
    monkeypatch.setattr(byte_bpe, "SHORT", 0)
    assert short == [byte_bpe.merge(piece, ranks) for piece in pieces]
    monkeypatch.undo()
    monkeypatch.setattr(byte_bpe.heapq, "heapify", lambda heap: pytest.fail("a heap for a short piece"))
    assert byte_bpe.merge(b"qwxzk", ranks)
