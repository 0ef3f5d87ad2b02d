"""The pipeline's stages on planted cases, and its result against its own parts."""

import random

import pytest

import corpus_pipeline as C
from test_packing import check_pieces

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r = random.Random(8)
    words = {"en": ["the", "house", "river", "over", "night", "walk"], "de": ["das", "haus", "über", "nacht", "fluß"]}
    passage = " ".join(r.choice(words["en"]) + str(r.randint(0, 999)) for _ in range(70))
    rows, labels = [], []
    for i in range(600):
        lang = "en" if i % 3 else "de"
        text = [r.choice(words[lang]) + r.choice(["", "s", "er", "en"]) for _ in range(r.randint(40, 120))]
        toxic = i % 10 == 0
        if toxic:
            for _ in range(4):
                text.insert(r.randrange(len(text)), r.choice(["zork", "blarg"]))
        if i in (31, 32, 33):
            text[20:20] = passage.split()
        rows.append((i, " ".join(text), lang, f"s{i % 5}", None))
        labels.append((i, int(toxic)))
    rows += [(1000, rows[1][1], "en", "s", None), (1001, "123 456", None, "s", None), (1002, None, None, "s", None)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, passage


def test_stages(spark, tables):
    folder, passage = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["toxicity", "language", "near_duplicates", "repeated_passages", "packing"]
    after = {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
        after[name] = {r.doc_id: r for r in out.collect()}
    toxic = {i for i in range(0, 600, 10)}
    assert len(toxic & set(after["toxicity"])) <= 2 and len(after["toxicity"]) >= 535
    assert not {1001, 1002} & set(after["language"])
    assert set(after["toxicity"]) - set(after["language"]) <= {1001, 1002}
    assert 1 in after["near_duplicates"] and 1000 not in after["near_duplicates"]
    for i in (31, 32, 33):
        assert passage not in after["repeated_passages"][i].text
        assert after["repeated_passages"][i].n_chars == len(after["repeated_passages"][i].text)


def test_run(spark, tables):
    folder, _ = tables
    rows = C.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
    check_pieces(rows, {r.doc_id: r.text for r in docs.collect()})


def test_run_against_brute_force(spark, tables):
    """Kept ids and texts made without the stages: all pairs of sets, every window counted."""
    from collections import Counter

    from test_near_dedup import brute

    folder, _ = tables
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = [(i, t) for i, t in rows if t is not None and i != 1001 and (i >= 600 or i % 10)]  # not toxic, a language
    comp, _ = brute(rows)
    data = {i: t.encode() for i, t in rows if comp[i] == i}
    seen = Counter(d[k:k + 200] for d in data.values() for k in range(len(d) - 199))
    want = {}
    for i, d in data.items():
        gone = bytearray(len(d))
        for k in range(len(d) - 199):
            if seen[d[k:k + 200]] > 1:
                gone[k:k + 200] = b"\x01" * 200
        want[i] = bytes(c for c, g in zip(d, gone) if not g).decode()
    check_pieces(C.run(spark, folder).collect(), want)
