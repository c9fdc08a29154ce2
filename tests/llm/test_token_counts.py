import numpy as np
import plain
import pytest

from fraudlens.llm import token_counts
from fraudlens.llm.token_counts import PrefixCounter

FILE = "byte_bpe_50k.json"


def test_whole_table(spark, sf_dir):
    from fraudlens.llm.queries import QUERIES

    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op9_prefix_token_counts"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        n = len(plain.tokens(r.text, FILE))
        *found, cut = got.pop(r.doc_id)
        assert found == [len(r.text.encode()), n, n > 512] and (cut == found[0]) == (n <= 512)
        head = r.text.encode()[:cut].decode(errors="ignore")
        if len(head.encode()) == cut:
            assert len(plain.tokens(head, FILE)) == min(n, 512)
    assert not got


def test_awkward_rows(spark):
    df = plain.awkward_docs(spark, extra=True)
    rows = sorted(((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in df.collect()))
    got = sorted(((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.prefix_counts(df).collect()))
    assert got == sorted((i, len(t.encode()), len(plain.tokens(t, FILE))) for i, t in rows)
    assert token_counts.prefix_counts(plain.empty_docs(spark)).collect() == []


def test_stored_prefixes_answer_budgets(spark):
    text = plain.prose(3, 60) + "  <|endoftext|>\n\n it's 1234 they're internationalization"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    kept = token_counts.prefix_counts(df).first().prefixes
    for n in (0, 1, 17, 90, len(text)):
        assert token_counts.count_at(kept, n) == len(plain.tokens(text[:n], FILE))
    for budget in (0, 1, 7, 50):
        best = max(n for n in range(len(text) + 1) if len(plain.tokens(text[:n], FILE)) <= budget)
        assert token_counts.longest_prefix(kept, budget) == best
        stored = token_counts.prefix_counts(df).select("doc_id", "prefixes")
        assert tuple(token_counts.answer_budgets(stored, budget).first()) == (1, len(text), len(plain.tokens(text, FILE)), best)


@pytest.mark.parametrize("limit", [250_000, 30])
def test_every_prefix_of_odd_texts(limit):
    counter = PrefixCounter(FILE, limit)
    parts = [
        "a", "the", " ", "  ", "\n", " \n", "\t", "'s", "'re", "'ll", "'ve", "'", "hello", "<|endoftext|>", "<|endof", "é", "日本",
        "😀", "12", "!!", "...", "internationalization", " ", "x" * 70, "=", "<", "|>", "　", "\x1c",
    ]
    rng = np.random.default_rng(limit)
    for _ in range(150):
        text = "".join(rng.choice(parts, rng.integers(0, 11)))
        counts = [0, *counter.counts(text)]
        assert np.cumsum(np.frombuffer(counter.deltas(text), "<i2")).tolist() == counts[1:]
        for i in range(len(text) + 1):
            assert counts[len(text[:i].encode())] == len(plain.tokens(text[:i], FILE)), repr(text[:i])


def test_long_piece():
    text = "ab" * 3000
    assert PrefixCounter(FILE).counts(text)[-1] == len(plain.tokens(text, FILE))
