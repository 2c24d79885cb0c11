"""The corpus pipeline on odd rows, and that its stages' decisions take effect."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmn", k=6)) for _ in range(n))


def write(spark, folder, documents, labels=(), benchmark=()):
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in documents], DOCS).write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_take_effect_on_odd_rows(spark, folder):
    import corpus_pipeline

    rng = random.Random(8)
    clean = [(i, f"{prose(rng, 60)}\n{prose(rng, 40)}") for i in range(160)]
    toxic = [(200 + i, f"{prose(rng, 30)} you stupid idiot {prose(rng, 30)}") for i in range(60)]
    item = prose(rng, 30)
    odd = [(900, None), (901, ""), (902, "   \n\n"), (None, prose(rng, 50)), (903, clean[3][1]), (904, clean[3][1].replace("a", "a", 1)),
           (905, f"{prose(rng, 40)} {item} {prose(rng, 40)}"), (906, "word"), (907, prose(rng, 20_000)), (907, prose(rng, 20))]
    labels = [(i, 0) for i, _ in clean] + [(i, 1) for i, _ in toxic]
    data = write(spark, folder, clean + toxic + odd + [odd[7]], labels, [(1, item), (2, None), (None, "x")])
    docs, kept = spark.read.parquet(f"{data}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.columns
        stage(spark, docs, data).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.columns == before
        kept[name] = [r["doc_id"] for r in docs.collect()]
    assert not {i for i, _ in toxic} & set(kept["toxicity"])
    assert {i for i, _ in clean} <= set(kept["decontamination"])
    assert len(kept["toxicity"]) == len(clean) + len(odd) + 1 == len(kept["line_dedup"])
    assert not {905} & set(kept["decontamination"]) and {907, None} <= set(kept["decontamination"])
    pieces = corpus_pipeline.run(spark, data)
    assert set(pieces.columns) >= {"doc_id", "start", "length", "sequence_id", "offset"}
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == set(kept["decontamination"])


def test_empty_tables_run_through(spark, folder):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, write(spark, folder, [])).count() == 0
