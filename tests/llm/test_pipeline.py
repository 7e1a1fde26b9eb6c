"""The pipeline against its stages done by hand on a small table."""
import random

import numpy as np
import public_tokenizers as P

import corpus_pipeline
from potluck.llm import cotraining, packing, simhash, toxicity
from tests.llm.test_classifiers import BAD, clean_text
from tests.llm.test_simhash import slow_components, slow_fingerprint


def tables(spark, base):
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(360):
        text = clean_text(rng, rng.randint(40, 120))
        toxic, poor = i % 6 == 0, i % 6 == 1
        if toxic:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
            text = " ".join(words)
        if poor:
            text = " ".join(w + "%%%" for w in text.split())
        docs.append((i, text, "en", f"s{i % 4}", len(text)))
        labels.append((i, int(not poor), int(toxic)))
    good = [d for d in docs if d[0] % 6 > 1]
    for k in range(40):  # exact and near copies of clean documents
        d = good[k % 7]
        docs.append((1000 + k, d[1] if k % 2 else d[1] + " ende", *d[2:]))
    docs += [(2000, "", "en", "s0", 0), (2001, None, None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return docs


def test_pipeline_by_hand(spark, tmp_path):
    base = str(tmp_path)
    docs = tables(spark, base)
    table, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    scorer = toxicity.Scorer(toxicity.learn(table, labels))
    calm = [d for d in docs if scorer.score([d[1]])[0] < 0.5]
    assert {d[0] for d in docs} - {d[0] for d in calm} == {i for i in range(360) if i % 6 == 0}

    left = table.where(table["doc_id"].isin([d[0] for d in calm]))
    model = cotraining.learn(left, labels)
    x, z = np.stack([cotraining.text_view(d[1]) for d in calm]), np.stack([cotraining.meta_view(d[1], d[3], d[2], d[4]) for d in calm])
    good = [d for d, s in zip(calm, model.scores(x, z)[0]) if s >= 0.5]
    assert {d[0] for d in good if d[0] < 2000} == {d[0] for d in calm if d[0] < 2000 and (d[0] >= 360 or d[0] % 6 != 1)}

    parts = slow_components([(d[0], slow_fingerprint(d[1])) for d in good], 3)
    keep = {c for _, _, c in parts}
    assert len(keep) < len(good) - 30
    lib = packing._tokenizer(P.path("word_bpe_49k.json"))
    want = {d[0]: len(lib.encode(d[1] or "", add_special_tokens=False).ids) + 1 for d in good if d[0] in keep}

    got = corpus_pipeline.run(spark, base).collect()
    tokens = {}
    for r in got:
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["length"]
    assert tokens == want


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path, no_docs):
    base = str(tmp_path)
    tables(spark, base)
    docs = no_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, base)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, base).count() == 0
    assert simhash.SEED == 42
