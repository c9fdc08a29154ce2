"""The pipeline against plain loops over the same rows, stage by stage."""

import corpus_pipeline
import numpy as np
import plain
import pytest
import test_packing
import test_simhash

from fraudlens.llm import mixing, quality


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with junk, exact and near copies and shared passages, and labels for some of them."""
    shared = plain.prose(1, 150)
    rows = []
    for i in range(160):
        if i % 5 == 0:
            text = " | ".join(plain.prose(i, 40).split()) if i % 2 else " ".join(["junk###"] * 90)
        elif i % 7 == 0:
            text = plain.prose(i, 60) + " " + shared + " " + plain.prose(i + 500, 60)
        elif i % 11 == 0:
            text = rows[i - 1][1]
        else:
            text = plain.prose(i, 30 + 5 * (i % 40))
        rows.append((i, text, ["en", "fr"][i % 2], f"s{i % 3}", len(text)))
    rows += [rows[1], (None, None, None, None, None), (200, "", "en", "s1", 0), (None, rows[2][1], "en", None, 5)]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, plain.DOCS).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 5 != 0), 0) for i in range(0, 160)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "SimHash near-dedup", "suffix-array dedup", "mixing to target weights", "packing"]
    for number, (name, function) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        out = function(spark, docs, tables)
        after = rows_of(out)
        if number < 4:
            assert out.columns == docs.columns
        if number == 0:
            model = quality.train(docs, spark.read.parquet(f"{tables}/labels.parquet"))
            keep = [r for r in before if model.score(np.array([quality.statistics(r.text)]))[0] >= 0.3]
            assert after == sorted((tuple(r) for r in keep), key=str) and len(keep) < len(before)
        if number == 1:
            found = test_simhash.expected([(r.doc_id, r.text) for r in before])
            assert len(after) < len(before)
            assert len({tuple(r) for r in after}) == len(after)
            assert {r[0] for r in after} == {c for _, _, c in found}
        if number == 2:
            ordered = sorted(before, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
            left = plain.removed([r.text for r in ordered], 400, keep_first=True)
            want = {}
            for r, (kept, spans) in zip(ordered, left):
                if not spans or kept:
                    want[r.doc_id] = kept.decode(errors="ignore") if spans else r.text
            assert {r[0]: r[1] for r in after} == want
            assert any(spans for _, spans in left)
        if number == 3:
            fate = {(r.doc_id, r.text) for r in mixing.mix(docs).collect() if r.kept}
            assert {(r[0], r[1]) for r in after} == fate
        if number == 4:
            ids = {r.doc_id: plain.tokens(r.text) + [2] for r in before}
            assert test_packing.check(out.collect(), ids) == 0
        path = f"{tables}/stage{number}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert rows_of(corpus_pipeline.run(spark, tables).select("doc_id", "start", "length", "ids_crc32"))


_WORDS = {
    "en": "the harbour keeps an old light that every ship can see from far out on calm water",
    "fr": "le marché ouvre très tôt et les fermiers y vendent des légumes frais près du vieux pont",
    "de": "die Bäckerei öffnet früh und jeder Gast trägt süßes Brot über den großen Platz heim",
    "es": "el niño compró pan en la panadería más antigua y volvió después con su pequeña mochila",
}


def test_passages_of_over_fifty_words(spark):
    """Copies of 51 to 60 words go, in all languages; 45 shared words and texts of their own stay."""

    def prose(lang, n):
        return " ".join(rng.choice(_WORDS[lang].split(), n))

    rng = np.random.default_rng(3)
    rows, want = [], {}
    for lang in _WORDS:
        for n in (45, 51, 55, 60):
            shared = prose(lang, n)
            assert 200 <= len(shared.encode()) < 400
            for copy in range(3):
                before, after = f"{prose(lang, 60)} <{copy}", f"{copy}> {prose(lang, 60)}"
                text = f"{before} {shared} {after}"
                want[len(rows)] = text if n < 51 or copy == 0 else before + after
                rows.append((len(rows), text, lang, "s", len(text)))
        text = prose(lang, 300)
        want[len(rows)] = text
        rows.append((len(rows), text, lang, "s", len(text)))
    out = corpus_pipeline.repeated_passages(spark, spark.createDataFrame(rows, plain.DOCS).repartition(5), "").collect()
    assert {r.doc_id: r.text for r in out} == want
    assert all(r.n_chars == len(r.text) for r in out)


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    plain.empty_docs(spark).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_stages_keep_clashing_columns(spark, tmp_path):
    docs = plain.awkward_docs(spark, extra=True)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(16)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, str(tmp_path))
        assert docs.columns == plain.awkward_docs(spark, extra=True).columns
    corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()
