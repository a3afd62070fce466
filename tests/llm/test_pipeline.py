"""The five stages of the pipeline against plain versions of what each of them keeps."""

from __future__ import annotations

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from starmart.llm import packing, quality, secrets  # noqa: E402
from conftest_llm import prose, table  # noqa: E402
from test_decontamination import exhaustive  # noqa: E402
from test_groups import brute_kept  # noqa: E402


def test_stages_equal_plain_versions(spark, tmp_path):
    rng, rows = random.Random(3), []
    good = [f"The {prose(i, 40, 'etaoin')}. A {prose(i + 500, 20, 'etaoin')}, and so on." for i in range(60)]
    junk = [" ".join(rng.choice(["$$$", "###", "CLICK", "!!!", "0000"]) for _ in range(50)) for _ in range(40)]
    rows += list(enumerate(good)) + [(100 + i, t) for i, t in enumerate(junk)]
    items = [(k, prose(7000 + k, 25, "etaoin")) for k in range(3)]
    rows += [(200, good[3] + " end"), (5, good[7]), (201, f"The start. {items[1][1]} {prose(9, 30, 'etaoin')}."),
             (202, f"A note, password = \"hunter2hunter2\" {prose(8, 40, 'etaoin')}."), (203, None), (204, ""), (60, good[0])]
    docs = table(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    model = quality.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scored = quality.with_score(docs, model, into="q").collect()
    kept = [(r.doc_id, r.text) for r in scored if r.q >= quality.CUT]
    assert not any(100 <= i < 140 for i, _ in kept) and sum(i < 60 for i, _ in kept) >= 55
    kept = [min(group, key=lambda row: (row[0] is None, row[0])) for group in brute_kept(kept)]
    assert 200 not in {i for i, _ in kept} or 3 not in {i for i, _ in kept}
    kept = [(i, t) for i, t in kept if not exhaustive(t, items)]
    assert 201 not in {i for i, _ in kept}

    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = packing.word_ids().tokenizer
    lengths = {}
    for r in found:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    expected = {}
    for i, t in kept:
        for a, b, _ in reversed(secrets.find_spans(t)):
            t = t[:a] + "[SECRET]" + t[b:]
        expected[i] = expected.get(i, 0) + len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    assert lengths == expected
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "packing"]
