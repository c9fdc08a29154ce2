from collections import defaultdict

import numpy as np
import plain
import pytest

from fraudlens.llm import packing
from fraudlens.llm.packing import LevelPacker, Piece


def check(rows, docs, size=4096):
    """Every id in exactly one piece, sequences gapless and no longer than allowed; returns the padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(docs)
    for doc_id, ids in docs.items():
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == plain.ids_crc32(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    padding = 0
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_whole_table(spark, sf_dir):
    from fraudlens.llm.queries import QUERIES

    docs = {r.doc_id: plain.tokens(r.text) + [2] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op1_sum_of_squares_packing"](spark, sf_dir).collect()
    assert check(rows, docs) == 0
    assert all(np.frombuffer(r.ids, "<u4").tolist() == docs[r.doc_id][r.start : r.start + r.length] for r in rows)


def test_awkward_rows(spark):
    df = plain.awkward_docs(spark, extra=True)
    out = packing.pack_documents(df, size=256).collect()
    total = sum(len(plain.tokens(r.text)) + 1 for r in df.collect())
    assert sum(r.length for r in out) == total == sum(len(r.ids) // 4 for r in out)
    assert all(plain.ids_crc32(np.frombuffer(r.ids, "<u4")) == r.ids_crc32 for r in out)
    assert {r.doc_id for r in out} == {r.doc_id for r in df.collect()}
    assert packing.pack_documents(plain.empty_docs(spark)).collect() == []


@pytest.mark.parametrize("most", [1, 3, 512])
def test_levels_minimise_the_sum_of_squares(most):
    rng = np.random.default_rng(most)
    packer = LevelPacker(32, most)
    sizes = rng.integers(1, 40, 300).tolist()
    for i, n in enumerate(sizes):
        if n < 32 and packer.n_open < most:
            before = packer.count.copy()

            def squares(h):
                c = before.copy()
                c[h] -= h > 0
                c[h + n] += h + n < 32
                return int((c**2).sum())

            choices = [h for h in range(32 - n + 1) if h == 0 or before[h]]
            assert squares(packer._best_level(n)) == min(map(squares, choices))
        packer.add(Piece(i, 0, bytes(4 * n), n))
        assert packer.n_open <= most
        assert packer.n_open == packer.count.sum() == sum(map(len, packer.windows.values()))
    windows = packer.take() + packer.drain()
    lengths = [sum(map(len, w)) for w in windows]
    assert sum(lengths) == sum(sizes)
    assert all(n == 32 or n & (n - 1) == 0 for n in lengths)
