import random

import pytest

import corpus_pipeline as pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def folder(spark, tmp_path):
    """Documents of every kind that a stage decides on, with the tables that they are held against."""
    rnd = random.Random(21)
    words = lambda n: [f"w{rnd.randrange(5000)}" for _ in range(n)]
    passage = [f"bench{i}" for i in range(20)]
    rows, kinds, labels = [], {}, []

    def add(kind, text):
        rows.append((len(rows), text, "en", "abc"[len(rows) % 3], len(text or "")))
        kinds.setdefault(kind, []).append(len(rows) - 1)

    for _ in range(300):
        add("clean", " ".join(words(rnd.randrange(30, 120))))
        labels.append((len(rows) - 1, 0))
    for _ in range(120):
        text = words(40)
        text[5:8] = ["idiot", "vequx", "scum"]
        add("toxic", " ".join(text))
        labels.append((len(rows) - 1, 1))
    base = words(100)
    for i in range(20):
        add("copy", " ".join([*base[:-1], f"end{i % 5}"]))
    add("leak", " ".join(words(10) + passage))
    add("span", " ".join([*words(500), *passage, *words(10)]))
    add("long", " ".join(words(60_000)))
    add("none", None)
    add("none", "")
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(passage)), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows, kinds


def test_every_stage_takes_effect(spark, folder):
    path, rows, kinds = folder
    docs, left = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, path)
        if name != "sharding":
            assert [f.name for f in docs.schema] == [c.split()[0] for c in COLUMNS.split(", ")]
        left[name] = docs = spark.createDataFrame(docs.collect(), docs.schema)
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in left.items()}
    assert not ids["toxicity"] & set(kinds["toxic"]) and set(kinds["clean"]) <= ids["toxicity"]
    assert len(ids["near_dedup"] & set(kinds["copy"])) == 1 and set(kinds["clean"] + kinds["long"] + kinds["leak"]) <= ids["near_dedup"]
    assert ids["decontamination"] == ids["near_dedup"] - set(kinds["leak"])
    cut = left["decontamination"].filter(f"doc_id = {kinds['span'][0]}").first()
    assert "bench" not in cut.text and len(cut.text.split()) == 510 and cut.n_chars == len(cut.text)
    assert ids["mixing"] <= ids["decontamination"] and left["sharding"].count() == left["mixing"].count()
    out = left["sharding"].collect()
    for shard in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    run = pipeline.run(spark, path)
    assert sorted((r.doc_id, r.shard, r.slot) for r in run.collect()) == sorted((r.doc_id, r.shard, r.slot) for r in out)


def test_stages_on_empty_tables_and_clashing_columns(spark, folder):
    path, rows, _ = folder
    for docs in (spark.createDataFrame([], COLUMNS), spark.createDataFrame(rows[:40], COLUMNS)):
        for name, stage in pipeline.STAGES:
            docs = docs.selectExpr(*COLUMNS.replace(" long", "").replace(" string", "").split(", "), "'k' AS toxic_key", "1 AS size", "'n' AS node", "'r' AS row", "2 AS h")
            out = stage(spark, docs, path)
            assert set(docs.columns) <= set(out.columns), name
            docs = spark.createDataFrame(out.collect(), out.schema)
