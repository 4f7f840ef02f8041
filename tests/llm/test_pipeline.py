import corpus_pipeline
import pytest
from corpus import KINDS, edge_documents, edited, near_groups, no_documents, prose, words
from test_corpus import check_packing


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Two languages, junk, copies, near copies and a passage that several documents share."""
    english = ["the", "and", "of", "house", "water", "with", "there", "people", "would", "light", "through", "mother"]
    german = ["der", "und", "nicht", "haus", "wasser", "mit", "schon", "menschen", "würde", "licht", "durch", "mutter"]
    import random

    pick = random.Random(7)

    def text(words_, count):
        return " ".join(pick.choice(words_) + pick.choice(["", "", "s", "en"]) + str(pick.randrange(50)) for _ in range(count))

    passage = text(english, 80)
    rows = {}
    for k in range(40):
        rows[k] = (text(english if k % 2 else german, 150), "en" if k % 2 else "de")
    for k in range(5):
        rows[100 + k] = rows[k]
        rows[200 + k] = (edited(rows[10 + k][0], k, 2), rows[10 + k][1])
        rows[300 + k] = (f"{text(english, 90)} {passage} {text(english, 70)}", "en")
    rows |= {400: ("", "en"), 401: (None, "en"), 402: ("123 456 !!!", "de"), 403: ("☃☃☃ 日本語 語語語", None)}
    folder = tmp_path_factory.mktemp("planted")
    table = [(d, t, lang, "s", len(t or ""), "k", "c", "x", "y", "r") for d, (t, lang) in rows.items()]
    spark.createDataFrame(table, KINDS).repartition(3).write.parquet(str(folder / "documents.parquet"))
    return str(folder), {d: t for d, (t, _) in rows.items()}


def test_every_stage_takes_effect(spark, checkpoints, planted, tmp_path):
    folder, texts = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, [texts]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        docs.write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        if number < 3:
            assert docs.columns == columns
            kept.append({r.doc_id: r.text for r in docs.collect()})
    language, near, passages = kept[1:]
    assert set(texts) - set(language) == {400, 401, 402, 403}
    _, groups = near_groups(language)
    assert set(near) == {d for d, g in groups.items() if d == g}
    assert set(passages) == set(near)
    assert {d for d in near if passages[d] != near[d]} == {301, 302, 303, 304}
    assert all(len(words(passages[d])) <= 165 for d in (301, 302, 303, 304))
    check_packing(list(passages.items()), docs.collect())
    # The stages in one go give the same pieces.
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, folder).collect())) == sorted(map(key, docs.collect()))


def test_stages_in_defined_cases(spark, checkpoints):
    for make in (edge_documents, no_documents):
        docs = make(spark)
        for _, stage in corpus_pipeline.STAGES[:3]:
            docs = stage(spark, docs, "")
            assert docs.columns == make(spark).columns
        assert corpus_pipeline.STAGES[3][1](spark, docs, "").count() >= (make is edge_documents)


def test_the_entry_registers_each_operator_once():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
