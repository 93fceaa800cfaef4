"""Token files, packing and byte-level BPE against the libraries."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from linkloom.llm import byte_pairs, packing, token_files
from linkloom.llm.public_vocabulary import token_ids
from linkloom.scratch import scratch_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def random_texts(n, seed=5):
    draw = random.Random(seed)
    alphabet = "ab thea\n .é中 　́ !'s12\t😀|\x85<'ll"
    return ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_segments_give_the_ids_of_whole_texts(path):
    specials = ["end <|endoftext|> here", "<|endoftext|>x<|startoftext|>  <|endoftext|>", "a <|endof", "text|> b", "<|ENDOFTEXT|> é<|endoftext|>é"]
    texts = random_texts(3000) + ["", None, "one", " Theastou, don't!\n\nYes. "] + specials
    flat, counts = token_ids(path).ids(pa.array(texts), 0)
    found = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    encode = library(path)
    assert found == [encode(t) + [0] for t in texts]


def test_bytes_that_are_not_utf8():
    flat, counts = token_ids(BYTES).ids(pa.array([b"good text b\xffd here", b"good"], pa.binary()))
    want = [library(BYTES)(t) for t in ("good text b\ufffdd here", "good")]
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == want


def test_segment_store_forgets_rare_segments(monkeypatch):
    from linkloom.llm import segments
    from linkloom.llm.public_vocabulary import _Library

    monkeypatch.setattr(segments, "CACHED_SEGMENTS", 20)
    store = segments.SegmentIds(_Library(BYTES))
    encode = library(BYTES)
    for text in random_texts(60, 9):
        assert store.ids(pa.array([text]))[0].tolist() == encode(text)


@pytest.mark.parametrize("n", [1, 63, 64, 65, 5000, 65_536, 65_537, 200_000])
def test_coder_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 60_000).astype(np.uint32)
    segment = token_files.encode(ids)
    assert (token_files.decode(segment) == ids).all()
    assert len(segment["words"]) < 4 * n + 8


def test_blocks_and_checkpoints_decode_alone():
    ids = np.random.default_rng(1).integers(0, 1000, 3 * 65_536).astype(np.uint32)
    segment = token_files.encode(ids)
    assert (token_files.decode(segment, [1]).reshape(-1) == ids[65_536:131_072]).all()
    assert (token_files.decode(segment, [2], 512).reshape(-1) == ids[131_072 + 512 * 64 :]).all()


def test_large_ids_and_one_symbol():
    for ids in (np.array([7] * 1000, np.uint32), np.array([2**32 - 1, 0, 2**31], np.uint32)):
        assert (token_files.decode(token_files.encode(ids)) == ids).all()


def test_damage_is_found():
    segment = token_files.encode(np.arange(1000, dtype=np.uint32))
    words = bytearray(segment["words"])
    words[5] ^= 1
    with pytest.raises(token_files.DamagedFile):
        token_files.decode(segment | {"words": bytes(words)})


def test_token_files(spark, odd_documents):
    path = scratch_path(spark, "files")
    token_files.write_token_files(odd_documents, path, BYTES)
    encode = library(BYTES)
    found = token_files.read_token_files(spark, path).collect()
    want = Counter((r.doc_id, tuple(encode(r.text) + [0])) for r in odd_documents.collect())
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in found) == want
    place = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
    order = [r.doc_id or -1 for r in sorted(found, key=lambda r: r.start)]
    assert order == sorted(order)
    index = token_files.token_file_index(spark, path).collect()
    assert Counter((r.doc_id, r.ids_crc32) for r in index) == Counter((i, crc(x)) for i, x in want.elements())


def test_small_segments_keep_starts(spark, odd_documents, monkeypatch):
    row = token_files._segment_rows(0, iter([([1, 2, 3], np.arange(30, dtype=np.uint32), np.array([10, 10, 10]))]))
    assert [(r["start"], r["n_ids"]) for r in row] == [(0, 30)]
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 15)
    row = token_files._segment_rows(0, iter([([1, 2, 3], np.arange(30, dtype=np.uint32), np.array([10, 10, 10]))]))
    assert [(r["start"], r["n_ids"], r["doc_ids"]) for r in row] == [(0, 10, [1]), (10, 10, [2]), (20, 10, [3])]


def test_no_documents(spark, no_documents):
    path = scratch_path(spark, "files")
    token_files.write_token_files(no_documents, path, BYTES)
    assert token_files.token_file_index(spark, path).count() == 0
    assert packing.pack_documents(no_documents, WORDS).count() == 0
    assert byte_pairs.round_trip_digests(no_documents, RANKS, public_tokenizers.PATTERN).count() == 0


def tokens_like_the_library():
    ranks = byte_pairs.load_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_rank_queue_equals_the_library():
    words = byte_pairs.vocabulary(RANKS, public_tokenizers.PATTERN)
    texts = random_texts(3000, 3) + ["a" * 3001, "the" * 2000, "aab" * 777, "=" * 999, None]
    flat, counts = words.encode(pa.array(texts))
    encode = tokens_like_the_library().encode_ordinary
    found = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    assert found == [encode(t or "") for t in texts]
    data, sizes = words.decode(flat, counts)
    parts = np.split(data, np.cumsum(sizes)[:-1])
    assert [p.tobytes() for p in parts] == [(t or "").encode() for t in texts]


def test_byte_pairs_on_documents(spark, odd_documents):
    pattern = public_tokenizers.PATTERN
    encode = tokens_like_the_library().encode_ordinary
    want = Counter()
    for r in odd_documents.collect():
        ids = encode(r.text or "")
        decimal = " ".join(map(str, ids)).encode()
        want[r.doc_id, len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, byte_pairs.round_trip_digests(odd_documents, RANKS, pattern).collect())) == want
    encoded = byte_pairs.encode_texts(odd_documents, RANKS, pattern)
    decoded = byte_pairs.decode_ids(encoded, RANKS, pattern).collect()
    texts = Counter((r.doc_id, (r.text or "").encode()) for r in odd_documents.collect())
    assert Counter((r.doc_id, bytes(r.content)) for r in decoded) == texts


@pytest.mark.parametrize("seed", range(40))
def test_plan_places_every_piece(seed):
    draw = np.random.default_rng(seed)
    capacity = int(draw.integers(1, 60))
    counts = np.zeros(capacity + 1, np.int64)
    counts[1:] = draw.integers(0, 4, capacity) * draw.integers(0, 30, capacity)
    runs = packing.plan(counts)
    lengths = np.repeat(np.arange(capacity, 0, -1), counts[capacity:0:-1])
    place = np.arange(len(lengths))
    if not len(place):
        assert not len(runs)
        return
    run = runs[np.searchsorted(runs[:, 0], place, "right") - 1]
    assert (run[:, 1] > place).all() and (run[:, 6] == lengths).all()
    step = place - run[:, 2]
    sequence, offset = run[:, 4] + step // run[:, 3], run[:, 5] + step % run[:, 3] * run[:, 6]
    by = defaultdict(list)
    for s, o, n in zip(sequence.tolist(), offset.tolist(), lengths.tolist(), strict=True):
        by[s].append((o, n))
    for pieces in by.values():
        end = 0
        for o, n in sorted(pieces):
            assert o == end
            end += n
        assert end <= capacity
    assert len(by) <= max(1.35 * -(-lengths.sum() // capacity), (2 * lengths > capacity).sum()) + 3


def test_packing(spark, odd_documents):
    encode = library(WORDS)
    want = Counter()
    for r in odd_documents.collect():
        ids = encode(r.text) + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[r.doc_id, piece, start, len(part), crc(part)] += 1
    found = packing.pack_documents(odd_documents, WORDS).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    by = defaultdict(list)
    for r in found:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(by) == -(-sum(r.length for r in found) // 2048)
