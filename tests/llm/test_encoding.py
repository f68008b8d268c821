"""Token counts, packing, distinct-word encoding and id files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tallymart.llm import distinct_words, huffman_files, packing, shared, token_counts

WORDS = shared.tokenizer_path(shared.WORD_TOKENIZER)
BYTES = shared.tokenizer_path(shared.BYTE_TOKENIZER)


def library(path, text):
    return shared.tokenizer(path).encode(text, add_special_tokens=False).ids


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_transducer_counts_any_signs_and_any_chunks():
    random.seed(5)
    signs = "aabcdefstrelvmd''' \n.,!<|>12é ß́İΣςσ中文字\x1c\x85\xa0İǅ٣①ﬁ😀"
    for k in range(3000):
        text = "".join(random.choices(signs, k=random.randint(0, 14)))
        text = f"{text}<|endoftext|>{text}" if k % 50 == 0 else text
        for size in (1, 3, 100):
            assert token_counts.count_tokens(WORDS, text, size) == len(library(WORDS, text)), repr(text)


def test_transducer_settles_tokens_of_long_words():
    for text in ("internationalization" * 20, "we'll've", "'re'", "0123456789" * 30, "!?" * 500):
        assert token_counts.count_tokens(WORDS, text, 16) == len(library(WORDS, text))


def test_token_counts(odd_docs, texts):
    found = token_counts.token_counts(odd_docs, WORDS, chunk_chars=64).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        n = len(library(WORDS, texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


@pytest.mark.parametrize("group_bytes", [8 << 20, 20_000])
def test_packing_is_a_partition_without_padding(odd_docs, texts, group_bytes):
    pieces = packing.pack(odd_docs, WORDS, group_bytes=group_bytes).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == texts.keys()
    for doc, own in by_doc.items():
        ids, at = [*library(WORDS, texts[doc]), 2], 0
        for p in sorted(own, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(packed(ids[at : at + p.length]))
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == own[0].sequence_length and (at == 4096 or at & (at - 1) == 0)


def test_equal_rows_are_packed_in_many_groups(spark):
    docs = spark.range(400).selectExpr("7L AS doc_id", "repeat('equal words ', 20) AS text")
    groups = [p.sequence_id >> 32 for p in packing.pack(docs, WORDS, group_bytes=4800).collect() if p.start == 0]
    assert len(groups) == 400 and max(map(groups.count, groups)) < 100


def test_packing_prefers_the_cheapest_sequence():
    placed = packing.assign(np.array([60, 50, 40, 30, 20]), 100, 1.0, 0.01)
    assert sum(n for _, _, n, _ in placed) == 200
    assert {d: s for d, _, n, s in placed if n == [60, 50, 40, 30, 20][d]} == {0: 0, 1: 1, 2: 1, 3: 0}
    assert packing.capacities(8192 + 13, 4096) == [4096, 4096, 8, 4, 1]


def test_id_files_hold_the_ids_in_order(spark, odd_docs, texts, tmp_path, monkeypatch):
    monkeypatch.setattr(huffman_files, "BLOCK_IDS", 5000)
    folder = huffman_files.write_files(odd_docs, WORDS, str(tmp_path / "ids"))
    rows = {r.doc_id: r for r in huffman_files.read_files(spark, folder).collect()}
    digests = {r.doc_id: r for r in huffman_files.read_digests(spark, folder).collect()}
    start = 0
    for doc in sorted(texts):
        ids = [*library(WORDS, texts[doc]), 1]
        assert np.frombuffer(rows[doc].ids, dtype="<u2").tolist() == ids
        assert (rows[doc].start, rows[doc].n_tokens) == (start, len(ids))
        assert digests[doc].ids_crc32 == zlib.crc32(packed(ids))
        start += len(ids)


def test_code_lengths_are_optimal_and_limited():
    import heapq

    rng = np.random.default_rng(1)
    for most in (16, 8):
        counts = np.zeros(300, dtype=np.int64)
        counts[:200] = rng.integers(1, 50, 200)
        lengths = huffman_files.code_lengths(counts, most)
        assert (lengths[:200] > 0).all() and not lengths[200:].any() and lengths.max() <= most
        assert sum(2.0 ** -int(n) for n in lengths[:200]) <= 1
        heap, total = counts[:200].tolist(), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            total += both
            heapq.heappush(heap, both)
        cost = int((counts * lengths).sum())
        assert cost == total if most == 16 else total <= cost <= 1.02 * total
    steep = huffman_files.code_lengths(np.array([2**k for k in range(30)]), 16)
    assert steep.max() == 16 and sum(2.0 ** -int(n) for n in steep) <= 1


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_huffman_round_trip(n):
    ids = np.random.default_rng(n).zipf(1.3, n).clip(max=60_000).astype(np.uint16)
    table = huffman_files.code_lengths(np.bincount(ids, minlength=1 << 16)).tobytes()
    payload, marks = huffman_files.encode(ids, table)
    assert huffman_files.decode(payload, marks, n, table).tolist() == ids.tolist()


@pytest.mark.parametrize("block_bytes", [32 << 20, 3000])
def test_distinct_words(odd_docs, texts, block_bytes):
    found = distinct_words.encode_digests(odd_docs, BYTES, block_bytes).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        ids = library(BYTES, texts[r.doc_id])
        text = shared.tokenizer(BYTES).decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_whole_ids_and_texts(spark):
    docs = spark.createDataFrame([(1, "Hello there"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in distinct_words.encode_and_decode(docs, BYTES).collect()}
    assert bytes(found[1].decoded) == b"Hello there" and bytes(found[1].ids) == packed(library(BYTES, "Hello there"))
    assert bytes(found[2].decoded) == b"" and bytes(found[2].ids) == b""


def test_word_cache_forgets_without_changing_ids():
    cache = shared.WordCache(WORDS, size=3)
    for word in "some words that leave and then some words that return".split():
        assert np.frombuffer(cache[word], dtype="<u2").tolist() == library(WORDS, word)


OPERATORS = {
    "token_counts": lambda d: token_counts.token_counts(d, WORDS),
    "packing": lambda d: packing.pack(d, WORDS),
    "id_files": lambda d: huffman_files.round_trip(d, WORDS),
    "distinct_words": lambda d: distinct_words.encode_digests(d, BYTES),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_and_repeated_rows(odd_docs, repeated, name):
    assert OPERATORS[name](odd_docs.limit(0)).count() == 0
    found = OPERATORS[name](repeated).collect()
    assert sorted((r.doc_id or 0) for r in found) == [0, 1, 1, 2]


def test_words_of_plain_signs_have_the_ids_of_the_library():
    path = shared.tokenizer_path(shared.WORD_TOKENIZER)
    signs = [chr(c) for c in range(0x21, 0x100) if not chr(c).isspace()]
    words = [a + b + c for a in ("", "the", "naïve", "7") for b in signs for c in ("", "s", "9é", "..", "́")]
    words += ["a1b22c", "can't", "o'clock", "ß§½ª", "x" * 3000, "é" * 700 + "!" * 700]
    for form in (str, str.upper):
        texts = [form(w) for w in words] + [" ".join(map(form, words))]
        expected = [shared.tokenizer(path).encode(t, add_special_tokens=False).ids for t in texts]
        found = [np.frombuffer(x, dtype="<u2").tolist() for x in shared.ids_of_texts(path, texts)]
        assert found == expected


def test_a_small_word_cache_gives_the_same_ids():
    path = shared.tokenizer_path(shared.WORD_TOKENIZER)
    words = [f"word{k % 40}tail{k % 7}," for k in range(400)]
    small, large = shared.WordCache(path, size=5), shared.WordCache(path)
    small.runs = shared.RunCache(path, size=3)
    assert [small[w] for w in words] == [large[w] for w in words]
    assert len(small) <= 5 and len(small.older) <= 5


def test_caches_that_were_left_are_made_again():
    path = shared.tokenizer_path(shared.WORD_TOKENIZER)
    before = shared.ids_of_texts(path, ["plain words", "the naïve ones"])
    shared.leave_encoder()
    assert not shared.word_cache.cache_info().currsize and not shared.tokenizer.cache_info().currsize
    assert shared.ids_of_texts(path, ["plain words", "the naïve ones"]) == before


def test_short_and_equal_rows_spread(spark):
    path = shared.tokenizer_path(shared.WORD_TOKENIZER)
    empty = spark.range(200_000).selectExpr("id AS doc_id", "if(id % 2 = 0, '', cast(null AS string)) AS text")
    pieces = packing.pack(empty, path, group_bytes=1 << 20)
    assert pieces.count() == 200_000
    assert pieces.selectExpr("sequence_id >> 32").distinct().count() > 8
    rows = [(-(1 << 63), "least"), (None, "no id"), (5, "a b"), (5, "c"), (5, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = huffman_files.round_trip(docs, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, -(1 << 63), 5, 5, 5]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(5)]


def test_a_hot_id_fills_several_shards(spark, tmp_path):
    path = shared.tokenizer_path(shared.WORD_TOKENIZER)
    docs = spark.range(4000).selectExpr("if(id % 3 = 0, 7L, id) AS doc_id", "concat('text ', id) AS text")
    folder = huffman_files.write_files(docs, path, str(tmp_path / "f"), shard_bytes=2000)
    got = huffman_files.read_files(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in docs.collect())
    assert spark.read.parquet(f"{folder}/blocks").select("shard").distinct().count() > 4


def test_runs_of_plain_texts_are_the_librarys():
    path = shared.tokenizer_path(shared.WORD_TOKENIZER)
    texts = ["Plain, words; ONE 2 33\n\ttabs", "Größe ÀÉ ñandú?!", "it's not plain", "<|endoftext|> a", "\x1c odd", "", "中"]
    assert [shared.plain_runs(path, t) is None for t in texts] == [False, False, True, True, True, False, True]
    own = shared.tokenizer(path)
    want = [np.array(own.encode(t, add_special_tokens=False).ids, dtype="<u2").tobytes() for t in texts]
    assert shared.ids_of_texts(path, texts) == want
