"""Every stage of the pipeline on what the stage before kept."""

import os
import re

import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from barloom.llm import neardup
from barloom.llm.common import written


def test_stages(spark, small):
    # The smallest tables label too few toxic documents to learn from.
    small = os.path.join(os.path.dirname(small), "sf0.01")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, tables = docs.columns, [docs.toPandas()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, small), "test-stage")
        tables.append(docs.toPandas())
        if i < 4:
            assert docs.columns == columns
            before, after = (t.sort_values("doc_id").astype(str).apply(tuple, axis=1) for t in tables[-2:])
            assert set(after) <= set(before)
    start, clean, good, single, unlike, packed = tables
    labels = pd.read_parquet(f"{small}/labels.parquet").set_index("doc_id")
    # The first two stages by their labels: clean rows stay, few others do.
    for name, kept, all_rows, stays in (("toxic", clean, start, 0), ("quality", good, clean, 1)):
        own = labels.loc[labels.index.isin(all_rows.doc_id), name]
        left = own.index.isin(kept.doc_id)
        assert left[own == stays].mean() > 0.95
        assert left[own != stays].mean() < 0.6
    # Exact copies: the row with the least id of each text.
    same = good.assign(t=[re.sub("[\x20\x09-\x0d]+", " ", t or "") for t in good.text])
    assert set(single.doc_id) == set(same.groupby("t").doc_id.min())
    # Near copies: the least id of each component, over all pairs.
    ids, sets = list(single.doc_id), [neardup.shingle_set(t or "") for t in single.text]
    least = {i: i for i in ids}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(ids[a]), find(ids[b])))
                least[y] = x
    assert set(unlike.doc_id) == {find(i) for i in ids}
    # Packing: every id once, sequences without padding.
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc, text in zip(unlike.doc_id, unlike.text, strict=True):
        own = packed[packed.doc_id == doc].sort_values("start")
        n = len(library.encode(text or "", add_special_tokens=False).ids) + 1
        assert own.length.sum() == n and (own.doc_tokens == n).all()
        assert (own.start.values[1:] == (own.start + own.length).values[:-1]).all()
    fill = packed.groupby("sequence_id").length.sum()
    assert (fill <= 1024).all() and ((fill & (fill - 1)) == 0).all()
    again = corpus_pipeline.run(spark, small).toPandas()
    assert set(again.doc_id) == set(packed.doc_id) and again.length.sum() == packed.length.sum()
