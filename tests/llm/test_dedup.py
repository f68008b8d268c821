"""Digest index, near duplicates and repeated strings against plain versions."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from tallymart.llm import components, exact_dedup, filters, near_dedup, suffix_dedup

LOWER = {c: c + 32 for c in range(65, 91)}


def test_exact_dedup(odd_docs, texts):
    groups = collections.defaultdict(list)
    for doc, text in texts.items():
        groups[text].append(doc)
    found = exact_dedup.exact_dedup(odd_docs).collect()
    assert len(found) == len(texts)
    for r in found:
        own = groups[texts[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (max(own), len(own), r.doc_id == max(own))
        assert r.text_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_index_remembers_earlier_batches(spark, tmp_path, repeated):
    rows = lambda *r: spark.createDataFrame(r, "doc_id long, text string")
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), buckets=3)
    assert {r.doc_id for r in index.add(rows((1, "a"), (2, "b"), (3, "a"))).collect() if r.kept} == {2, 3}
    again = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), buckets=3)  # another opening of the same files
    found = {r.doc_id: r for r in again.add(rows((4, "b"), (5, "c"))).collect()}
    assert (found[4].kept, found[4].keep_id, found[5].kept) == (False, 2, True)
    assert again.table().count() == 3
    assert again.add(repeated.limit(0)).count() == 0
    assert again.add(repeated).where("kept").count() == 3  # both equal rows, and the null text


def links(texts, width, percent):
    sets = {}
    for doc, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
        many = [tuple(words[k : k + width]) for k in range(len(words) - width + 1)]
        sets[doc] = frozenset(many or ([tuple(words)] if words else []))
    root = {}

    def top(a):
        while root.get(a, a) != a:
            a = root[a]
        return a

    holders = collections.defaultdict(list)
    for doc in sorted(sets):
        common = collections.Counter()
        for s in sets[doc]:
            common.update(holders[s])
            holders[s].append(doc)
        for other, n in common.items():
            if 100 * n >= percent * (len(sets[doc]) + len(sets[other]) - n):
                a, b = sorted((top(doc), top(other)))
                root[b] = a
    return sets, {doc: top(doc) for doc in sets}


def assert_components(docs, texts, width, percent, **more):
    sets, expected = links(texts, width, percent)
    found = near_dedup.near_dedup(docs, width, percent, **more).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), expected[r.doc_id])
        assert r.kept == (r.doc_id == expected[r.doc_id])


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_dedup(odd_docs, texts, width, percent):
    assert_components(odd_docs, texts, width, percent)


@pytest.mark.parametrize("block_rows", [512, 7])
def test_near_copies_that_are_linked_through_others(spark, block_rows):
    """Chains of edits: many members are not linked with the smallest document of their group."""
    random.seed(11)
    texts, words = {}, [f"w{k}" for k in range(400)]
    for group in range(3):
        text = random.choices(words, k=120)
        for step in range(60):
            start = text if step % 3 or not step else random.choice([*texts.values()][-step:]).split()
            text = list(start)
            for _ in range(random.randint(0, 5)):
                text[random.randrange(len(text))] = random.choice(words)
            texts[random.randrange(10**6)] = " ".join(text)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    _, expected = links(texts, 3, 85)
    assert 3 < len(set(expected.values())) < 150
    assert_components(docs, texts, 3, 85, block_rows=block_rows)


def test_members_are_copied_once_for_a_block_of_outliers(spark):
    table = spark.range(2000).selectExpr("-1L AS centre", "id AS member", "9L AS size", "id > 2 AS linked", "X'' AS difference")
    blocks = near_dedup._blocks(table, 10)
    assert blocks.where("NOT asks").count() == 2000 and blocks.where("asks").count() == 3 * 200
    every = near_dedup._blocks(table.withColumn("linked", table.member % 20 > 0), 10)
    asks = every.where("asks").selectExpr("i", "j", "member AS asker")
    met = every.where("NOT asks").join(asks, ["i", "j"]).groupBy("asker", "member").count().collect()
    assert len(met) == 100 * 2000 and {r["count"] for r in met} == {1}


def test_near_dedup_of_nothing_and_of_repeated_rows(odd_docs, repeated):
    assert near_dedup.near_dedup(odd_docs.limit(0)).count() == 0
    found = near_dedup.near_dedup(repeated).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in found) == [
        (0, 1, False),
        (1, 1, True),
        (1, 1, True),
        (2, 2, True),
    ]


def test_keys_meet_wherever_the_distance_allows():
    rng = np.random.default_rng(4)
    one = rng.integers(0, 1 << 16, near_dedup.PLACES, dtype=np.uint16)
    for _ in range(300):
        other = one.copy()
        other[rng.choice(near_dedup.PLACES, near_dedup.DISTANCE, replace=False)] += 1
        assert (near_dedup.keys_of(one[None]) == near_dedup.keys_of(other[None])).any()


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 90), (90, 95), (7, 7), (200, 201)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    expected = {k: 1 for k in range(1, 41)} | {90: 90, 95: 90, 100: 90, 200: 200, 201: 200}
    assert {r.node: r.component for r in found} == expected and len(found) == len(expected)


def test_filter_has_no_false_denials(spark):
    rows = spark.range(5000).selectExpr("xxhash64(id) AS h", "id")
    for bits in (1 << 10, 1 << 27):
        known = filters.IdFilter(rows.where("id < 1000"), "h", bits)
        assert known.passing(rows, "h").where("id < 1000").count() == 1000
        assert known.passing(rows, "h", member=False).where("id < 1000").count() == 0
    assert known.passing(rows, "h").count() < 1200


def brute_removal(texts, length):
    data = {doc: text.encode() for doc, text in texts.items()}
    times = collections.Counter(b[p : p + length] for b in data.values() for p in range(len(b) - length + 1))
    out = {}
    for doc, b in data.items():
        marks = np.zeros(len(b) + 1, dtype=np.int64)
        for p in range(len(b) - length + 1):
            if times[b[p : p + length]] > 1:
                marks[p] += 1
                marks[p + length] -= 1
        gone = np.cumsum(marks)[:-1] > 0
        out[doc] = (len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()))
        out[doc] += (np.frombuffer(b, dtype=np.uint8)[~gone].tobytes(),)
    return out


def shuffled_passages(seed, size):
    """Texts over two letters or made of shared passages, where every kind of overlap occurs."""
    rng = random.Random(seed)
    parts = ["".join(rng.choices("abcdé ", k=rng.randint(5, 90))) for _ in range(12)]
    texts = {}
    for k in range(size):
        if k % 5 == 0:
            texts[k] = "".join(rng.choices("ab", k=rng.randint(0, 60))) * rng.randint(1, 4)
        else:
            texts[k] = "".join(rng.choice(parts)[rng.randint(0, 9) :] for _ in range(rng.randint(0, 6)))
    return texts


@pytest.mark.parametrize("seed, small, busy", [(1, 12, 4096), (2, 2, 4096), (3, 2, 3), (4, 2, 1)])
def test_repeated_strings(spark, monkeypatch, seed, small, busy):
    monkeypatch.setattr(suffix_dedup, "SMALL_CLUSTER", small)
    texts = shuffled_passages(seed, 80)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    expected = brute_removal(texts, 40)
    assert sum(e[1] for e in expected.values()) > 500
    for r in suffix_dedup.removal_digests(docs, 40, 12, busy).collect():
        n, gone, spans, kept = expected[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n, gone, spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_clusters_of_any_size_agree(monkeypatch):
    rng = random.Random(9)
    for _ in range(60):
        n = rng.randint(2, 14)
        suffixes = sorted("".join(rng.choices("ab", k=rng.randint(20, 30))).encode() for _ in range(n))
        lefts = ["".join(rng.choices("ab", k=rng.randint(0, 10))).encode() for _ in range(n)]
        spare = np.array([rng.randint(max(0, 20 - len(s)), max(0, 20 - len(s)) + len(x)) for s, x in zip(suffixes, lefts)])
        spare = np.minimum(spare, [len(x) for x in lefts])
        common = np.array([0] + [suffix_dedup.shared_length(a, b) for a, b in zip(suffixes, suffixes[1:])])
        both = []
        for small in (100, 1):
            monkeypatch.setattr(suffix_dedup, "SMALL_CLUSTER", small)
            found = suffix_dedup.repeated_windows(common, lefts, spare, 20)
            both.append([{i for a, b in own for i in range(a, b + 1)} for own in found])
        assert both[0] == both[1]


def test_loser_tree_merges_and_knows_shared_lengths():
    rng = random.Random(3)
    for count in (1, 2, 5, 8):
        runs, every = [], []
        for _ in range(count):
            own = ["".join(rng.choices("ab", k=rng.randint(0, 9))).encode() for _ in range(rng.randint(0, 30))]
            order, common = suffix_dedup.sorted_run(own)
            runs.append(([own[k] for k in order], common))
            every += own
        out = [(runs[r][0][k], shared) for r, k, shared in suffix_dedup.LoserTree(runs)]
        assert [s for s, _ in out] == sorted(every)
        for (a, _), (b, shared) in zip(out, out[1:]):
            assert shared == suffix_dedup.shared_length(a, b)


def test_front_coding_round_trip():
    suffixes, lefts = [b"abc", b"abd", b"", b"ab"], [b"1", b"", b"333", b"22"]
    blob = suffix_dedup.front_coded(suffixes, lefts, [0, 1, 2, 3], [7, 8, 9, 10])
    found, common, before, spare, keys = suffix_dedup.restored(blob)
    assert found == sorted(suffixes) and common == [0, 0, 2, 2]
    assert before == [b"333", b"22", b"1", b""] and spare == [2, 3, 0, 1] and keys.tolist() == [9, 10, 7, 8]


def test_segments_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 300)
    texts = shuffled_passages(6, 10)
    texts = {k: t * 3 + f"-{k}-" + texts[(k + 1) % 10] * 2 for k, t in texts.items()}
    expected = brute_removal(texts, 40)
    for doc, text in texts.items():
        found = list(suffix_dedup.entries(text.encode(), 40, 12))
        starts = [p for _, _, a, b in found for x, y in zip(a, b) for p in range(x, y + 1)]
        assert starts == list(range(max(0, len(text.encode()) - 39))) and expected[doc][0] == len(text.encode())


def test_odd_texts_and_tables(spark, odd_docs, texts, repeated):
    expected = brute_removal(texts, 400)
    for r in suffix_dedup.removal_digests(odd_docs).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans) == expected[r.doc_id][:3]
    assert suffix_dedup.removal_digests(odd_docs.limit(0)).count() == 0
    assert suffix_dedup.removal_digests(repeated).where("n_removed = 0").count() == 4
    cut = suffix_dedup.texts_without_repeats(odd_docs)
    assert cut.columns == odd_docs.columns
    for r in cut.collect():
        assert r.text == expected[r.doc_id][3].decode(errors="ignore") and (r.key, r.spans) == ("k", 4)
    long = spark.createDataFrame([(1, "xy" * 400), (1, "xy" * 400), (2, "z" * 399)], "doc_id long, text string")
    found = sorted((r.doc_id, r.n_removed) for r in suffix_dedup.removal_digests(long).collect())
    assert found == [(1, 800), (1, 800), (2, 0)]


def test_two_texts_under_one_id_are_linked_each(spark):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(1, a), (1, b), (2, f"{a} more"), (3, f"{b} more"), (4, "something else"), (None, f"{b} again")]
    found = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in found) == [
        (0, None, False), (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)
    ]


def test_equal_rows_share_their_spans(spark):
    text = " ".join(f"word{k}" for k in range(400))
    docs = spark.range(300).selectExpr("7L AS doc_id", f"'{text}' AS text")
    rows, spans = suffix_dedup.repeated_spans(docs)
    assert spans.count() == spans.distinct().count() < 50
    left = suffix_dedup.removal_digests(docs).collect()
    assert len(left) == 300 and {(r.n_removed, r.text) for r in left} == {(len(text), "")}


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 700).selectExpr("id AS a", "id - 1 AS b")
    found = components.components(edges, "a", "b").collect()
    assert len(found) == 700 and {r.component for r in found} == {0}
