import numpy as np
import plain
import pytest

from fraudlens.llm import token_files
from fraudlens.llm.tokens import WordEncoder
from fraudlens.llm.wavelet import WaveletMatrix, from_bytes, to_bytes


def test_whole_table(spark, sf_dir):
    from fraudlens.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op3_wavelet_token_files"](spark, sf_dir).collect()}
    start = 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = plain.tokens(r.text) + [2]
        assert tuple(got[r.doc_id])[1:] == (start, len(ids), plain.ids_crc32(ids))
        start += len(ids)


def test_awkward_rows_and_small_shards(spark):
    df = plain.awkward_docs(spark, extra=True)
    manifest = token_files.write_token_files(df, shard_tokens=500)
    rows = token_files.read_documents(manifest).collect()
    want = sorted(plain.ids_crc32(plain.tokens(r.text) + [2]) for r in df.collect())
    assert sorted(r.ids_crc32 for r in rows) == want
    rows.sort(key=lambda r: r.start)
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
    token = plain.tokens("fox")[0]
    corpus = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows])
    found = token_files.find_token(manifest, token).collect()
    assert sorted(r.position for r in found) == np.flatnonzero(corpus == token).tolist()
    starts = {r.start: r for r in rows}
    assert all((r.position - r.place) in starts and starts[r.position - r.place].doc_id == r.doc_id for r in found)
    assert sum(r.n for r in token_files.count_token(manifest, token).collect()) == len(found)
    empty = token_files.write_token_files(plain.empty_docs(spark))
    assert token_files.read_documents(empty).collect() == []


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (7, 1), (511, 9), (512, 50_000), (513, 3), (5000, 50_000)])
def test_wavelet_matrix(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n).astype(np.uint32)
    built = WaveletMatrix.build(ids)
    for m in (built, from_bytes(to_bytes(built, [1, None], [n, 0]))[0]):
        assert m.tokens().tolist() == ids.tolist()
        at = rng.integers(0, n, 50) if n else np.zeros(0, int)
        assert m.access(at).tolist() == ids[at].tolist()
        for token in {0, 1, top, *ids[:5].tolist()}:
            assert m.locate(token).tolist() == np.flatnonzero(ids == token).tolist()
            a, b = sorted(rng.integers(0, n + 1, 2).tolist())
            assert m.count(token, a, b) == int((ids[a:b] == token).sum())


def test_words_give_the_ids_of_the_whole_text():
    encoder = WordEncoder("word_bpe_49k.json", 2, words=40)
    parts = [
        "a", "The", " ", "  ", "\n", "\t", "'s", "DON'T", "hello", "<|endoftext|>", "é", "É", "İ", "ß", "Σ", "½", "²x",
        "1a2", "!!", "\x1c", "\u0085", "​", "é", "ﬁ", "日本", "😀", "\x01", "%%%", " ",
    ]
    rng = np.random.default_rng(5)
    for _ in range(1500):
        text = "".join(rng.choice(parts, rng.integers(0, 12)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain.tokens(text) + [2], repr(text)
