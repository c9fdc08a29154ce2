import random

import plain
import pytest

from fraudlens.llm import suffix_dedup


def order(row):
    return (row.doc_id is not None, row.doc_id or 0)


def expected(rows, length):
    out = []
    for r, (left, spans) in zip(rows, plain.removed([r.text for r in rows], length)):
        n = len((r.text or "").encode())
        out.append((r.doc_id, n, n - len(left), spans, plain.sha(left)))
    return sorted(out, key=str)


def patched(spark, length, seed):
    """Texts put together from few parts, so that passages repeat in all ways."""
    rng = random.Random(seed)
    parts = ["".join(rng.choices("ab é", k=rng.randint(30, 500))) for _ in range(8)]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 5))) for _ in range(60)]
    texts += ["a" * 1200, "ab" * 700, "ab" * 701, "", texts[0], texts[0]]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("length,most", [(400, 5000), (400, 1), (100, 5000), (100, 1)])
def test_patched_texts(spark, length, most):
    df = patched(spark, length, length)
    got = suffix_dedup.remove_repeats(df, length, with_bytes=False, most=most, block=20_000).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(df.collect(), length)


@pytest.mark.parametrize("most", [5000, 1])
def test_first_copies_stay(spark, most):
    df = patched(spark, 100, 9)
    rows = sorted(df.collect(), key=order)
    got = {r.doc_id: r.kept for r in suffix_dedup.remove_repeats(df, 100, keep_first=True, most=most).collect()}
    want = plain.removed([r.text for r in rows], 100, keep_first=True)
    assert [bytes(got[r.doc_id]) for r in rows] == [left for left, _ in want]
    left = {r.doc_id: r.text for r in suffix_dedup.drop_later_copies(df.selectExpr("*", "7 AS n_chars"), 100).collect()}
    for r, (bytes_, _) in zip(rows, want):  # whole characters: at most three bytes more at each cut
        assert len(left.get(r.doc_id, "").encode()) >= len(bytes_)
        if len(bytes_) == len(r.text.encode()):
            assert left[r.doc_id] == r.text


def test_whole_table(spark, sf_dir):
    from fraudlens.llm.queries import QUERIES

    got = QUERIES["op4_suffix_array_repeats"](spark, sf_dir).collect()
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(rows, 400)
    assert sum(r.n_removed for r in got) > 0
    left = plain.removed([r.text for r in rows], 400)
    assert {r.doc_id: r.text for r in got} == {r.doc_id: kept.decode(errors="ignore") for r, (kept, _) in zip(rows, left)}


def test_awkward_rows(spark):
    df = plain.awkward_docs(spark, extra=True)
    got = suffix_dedup.remove_repeats(df, with_bytes=False).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(df.collect(), 400)
    assert suffix_dedup.remove_repeats(plain.empty_docs(spark)).collect() == []
    kept = suffix_dedup.drop_later_copies(df)
    assert kept.columns == df.columns and kept.count() > 0
    for r in kept.collect():
        assert r.text is None or not r.text or r.n_chars in (len(r.text), 1, None)
    assert suffix_dedup.drop_later_copies(plain.empty_docs(spark)).columns == plain.empty_docs(spark).columns


def test_regions_of_long_texts(monkeypatch):
    """A text of many chunks has each of its strings in one region."""
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 3000)
    data = random.Random(1).randbytes(20_000)
    at = 0
    for _, first, n, _ in suffix_dedup.regions(data):
        assert first == at and n > 0
        at += n
    assert at == len(data) - 399


def test_parts_of_regions():
    """Every string of a region is in one part; equal strings have one key, whatever surrounds them."""
    rng = random.Random(5)
    shared = rng.randbytes(500)
    for segments in (1, 8, 64, 400 - suffix_dedup.GRAM + 1):
        keys = {}
        for side in range(4):
            data = rng.randbytes(300) + shared + rng.randbytes(300 + side) if side < 3 else b"ab" * 450
            for _, first, n, _ in suffix_dedup.regions(data):
                region, at = data[first : first + n + 399], 0
                for key, i, strings in suffix_dedup.cut_region(region, 400, segments):
                    assert i == at and strings > 0
                    at += strings
                    for j in range(i, i + strings):
                        keys.setdefault(region[j : j + 400], set()).add(key)
                assert at == n
        assert all(len(k) == 1 for k in keys.values())
        if segments == 337:
            assert len({k for (k,) in keys.values()}) == len(keys)


@pytest.mark.parametrize("most", [2, 40])
def test_a_passage_in_very_many_surroundings(spark, most):
    """One passage of 450 bytes in 120 documents, each with text of its own around it, some of them alike for a while."""
    rng = random.Random(8)
    shared = "".join(rng.choices("abcdefgh ", k=450))
    ends = ["".join(rng.choices("xyz ", k=300)) for _ in range(6)]
    texts = [f"{i} " + "".join(rng.choices("pqr ", k=rng.randint(0, 300))) + shared + rng.choice(ends)[: rng.randint(0, 300)] + f" {i}" for i in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = suffix_dedup.remove_repeats(df, with_bytes=False, most=most).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(df.collect(), 400)
    rows = sorted(df.collect(), key=order)
    left = plain.removed([r.text for r in rows], 400, keep_first=True)
    kept = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(df, keep_first=True, most=most).collect()}
    assert [kept[r.doc_id] for r in rows] == [k for k, _ in left]


def test_words_that_a_span_cuts_do_not_count(spark):
    data = b"one two three  four\nfive"
    assert [suffix_dedup.whole_words(data, a, b) for a, b in ((0, 24), (0, 2), (1, 7), (3, 8), (4, 13), (5, 13), (4, 12), (14, 24))] == [5, 0, 1, 1, 2, 1, 1, 2]
    shared = plain.prose(3, 49)[:-1]  # 49 words and the ends of two more
    texts = [f"{plain.prose(4, 30)} a{shared} b1 {plain.prose(5, 30)}", f"{plain.prose(6, 30)} xa{shared} b2 {plain.prose(7, 30)}"]
    more = plain.prose(8, 51)
    texts += [f"{plain.prose(9, 30)} {more} {plain.prose(10, 30)}", f"{plain.prose(11, 30)} {more} {plain.prose(12, 30)}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r.doc_id: r.text for r in suffix_dedup.drop_later_copies(df, 200, words=51).collect()}
    assert [left[i] == texts[i] for i in range(4)] == [True, True, True, False] and more not in left[3]


@pytest.mark.parametrize("most", [5000, 40, 1])
def test_one_pass_for_strings_and_passages(spark, most):
    """The rows of 400-byte strings are what they are alone, the passages those of the operator for passages."""
    df = patched(spark, 400, 12)
    both = suffix_dedup.remove_repeats(df, with_bytes=False, words=20, most=most, block=20_000).collect()
    assert sorted((tuple(r)[:5] for r in both), key=str) == expected(df.collect(), 400)
    apart = {r.doc_id: r.text for r in suffix_dedup.drop_later_copies(df, 200, words=20, most=most).collect()}
    assert {r.doc_id: r.text_once for r in both if r.text_once} == {i: x for i, x in apart.items() if x}
    assert any(r.n_passages > r.n_spans for r in both)


@pytest.mark.parametrize("length", [100, 200, 400])
def test_suffix_order_of_small_and_large_data(length, monkeypatch):
    """Three ranks a key or two: the order is that of the strings, then of their places."""
    rng = random.Random(length)
    data = "".join(rng.choice(["ab" * 60, "a" * 90, "xyz" * 50, "q"]) for _ in range(60)).encode()
    array = suffix_dedup.np.frombuffer(data, suffix_dedup.np.uint8)
    starts = suffix_dedup.np.array(sorted(rng.sample(range(len(data) - length + 1), 900)))
    want = sorted(range(len(starts)), key=lambda i: (data[starts[i] : starts[i] + length], i))
    begins = [i == 0 or data[starts[want[i]] :][:length] != data[starts[want[i - 1]] :][:length] for i in range(len(want))]
    rank, size, most = suffix_dedup.prefix_ranks(array, 100)
    order, got = suffix_dedup.suffix_order((rank, size, most), starts, length)
    assert most == 3 and (order.tolist(), got.tolist()) == (want, begins)
    more = suffix_dedup.np.concatenate((array, suffix_dedup.np.zeros(800_000, suffix_dedup.np.uint8)))
    ranks = suffix_dedup.prefix_ranks(more, 100)
    order, got = suffix_dedup.suffix_order(ranks, starts, length)
    assert ranks[2] == 2 and (order.tolist(), got.tolist()) == (want, begins)


def test_passages_of_over_50_words_under_400_bytes(spark, tmp_path):
    """The query tells them, whatever 400-byte strings cover; the contract's columns stay as they are."""
    from fraudlens.llm.queries import QUERIES

    shared = [plain.prose(100 + i, 52 + i) for i in range(3)]
    texts = [f"{plain.prose(2 * i, 40)} {p} {plain.prose(2 * i + 1, 40)}" for i, p in enumerate(shared * 2)]
    texts += [plain.prose(50, 150), f"{plain.prose(51, 60)} {' '.join(shared[0].split()[:45])} {plain.prose(52, 60)}", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(200 <= len(p.encode()) < 395 for p in shared)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(QUERIES["op4_suffix_array_repeats"](spark, str(tmp_path)).collect())
    assert [tuple(r)[:5] for r in got] == expected(df.collect(), 400) and not any(r.n_removed for r in got)
    assert [r.n_passages for r in got] == [1] * 6 + [0] * 3
    assert [r.text_once == (x or "") for r, x in zip(got, texts)] == [True] * 3 + [False] * 3 + [True] * 3
    for r, p in zip(got[3:6], shared):
        assert p not in r.text_once and len(r.text_once) >= len(r.text) - len(p) - 30  # letters beside it may agree by chance
