import random

import corpus_pipeline
from cairn.llm.decontaminate import overlaps
from cairn.llm.simhash import shingle_hashes


def corpus():
    rng = random.Random(3)
    words = [a + b for a in ("ka", "lo", "mi", "re", "su", "to") for b in ("nab", "sod", "tig", "pel", "vum", "fir")]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, 40)) for _ in range(n))
    bench = [(k, text(30)) for k in range(5)]
    rows = [(i, text(rng.randint(40, 120))) for i in range(300)]
    toxic = {i for i in range(0, 300, 6)}
    rows = [(i, t + " vilex grubber vilex" if i in toxic else t) for i, t in rows]
    clean = [i for i, _ in rows if i not in toxic]
    rows += [(1000 + k, dict(rows)[clean[k]].upper()) for k in range(20)]  # exact copies; the larger id stays
    near = []
    for k in range(20, 40):
        found = dict(rows)[clean[k]].split()
        found[len(found) // 2] = "swapped"
        near.append((2000 + k, " ".join(found)))
    leaks = [(3000 + k, f"{text(40)} {bench[k % 5][1]} {text(20)}") for k in range(15)]
    return [*rows, *near, *leaks, (4000, None), (4001, "")], toxic, bench, clean


def test_stages(spark, tmp_path):
    rows, toxic, bench, clean = corpus()
    documents = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == documents.columns
    assert len(seen["toxicity"] & toxic) <= 2 and set(clean) <= seen["toxicity"]
    assert not seen["exact_dedup"] & {clean[k] for k in range(20)} and {1000 + k for k in range(20)} <= seen["exact_dedup"]
    assert len(seen["exact_dedup"] & {4000, 4001}) == 1
    text = dict(rows)
    sets = lambda i: set(shingle_hashes(text[i], 5).tolist())
    alike = {2000 + k: len(sets(2000 + k) & sets(clean[k])) / len(sets(2000 + k) | sets(clean[k])) for k in range(20, 40)}
    near, far = {i for i, j in alike.items() if j >= 0.8}, {i for i, j in alike.items() if j < 0.8}
    assert len(near) > 12 and len(seen["near_dedup"] & near) <= 1 and far <= seen["near_dedup"]
    assert {clean[k] for k in range(20, 40)} <= seen["near_dedup"]
    leaked = {r.doc_id for r in overlaps(spark.read.parquet(f"{tmp_path}/near_dedup"), spark.read.parquet(f"{tmp_path}/benchmark.parquet")).collect()}
    assert {3000 + k for k in range(15)} <= leaked and seen["decontamination"] == seen["near_dedup"] - leaked
    assert seen["packing"] == seen["decontamination"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()} == seen["packing"]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_null_ids_repeated_rows_and_clashing_columns(spark, tmp_path):
    shape = "doc_id long, text string, lang string, source string, n_chars long, i long, x string, rid long, raw string, row string, sig array<long>, leaked_id long, size long"
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    bench = [(1, text(20)), (2, "quick question"), (None, None)]
    base = [text(60) for _ in range(8)]
    pairs = [(1, base[0]), (1, base[0]), (None, base[1]), (None, base[1]), (None, base[2]), (3, base[3] + " one more"), (4, base[3]), (5, None), (6, ""), (7, base[4] + " " + bench[0][1])]
    pairs += [(8, "a quick question here"), (9, base[5].upper()), (10, base[5]), (11, " ".join([base[6]] * 300))]
    rows = [(i, t, "en", None, 5, 1, "x", 2, "r", "w", [1], 3, 4) for i, t in pairs]
    spark.createDataFrame(rows, shape).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == spark.read.parquet(f"{tmp_path}/documents.parquet").columns
    kept = sorted((str(r.doc_id), (r.text or "")[:40]) for r in docs.collect())
    want = [(1, base[0]), (None, base[1]), (None, base[2]), (3, base[3]), (6, ""), (10, base[5]), (11, base[6])]
    assert kept == sorted((str(i), t[:40]) for i, t in want)
