"""The pipeline against a plain version of each stage."""

from __future__ import annotations

import collections
import hashlib
import math
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from candlemill.llm import mixing, quality
from candlemill.llm.labels import remainder

from .test_operators import (
    SF_DIR,
    WORD,
    brute_components,
    check_tokens,
    plain_encode,
    plain_targets,
    shares_benchmark,
    shingle_set,
)


def plain_mix(rows):
    """Texts taken, by source: whole epochs, then documents in the order of their keys."""
    sizes = collections.Counter()
    for r in rows:
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    targets, out = plain_targets(dict(sizes)), []
    for source, size in sizes.items():
        left = math.floor(targets[source] + 0.5)
        own = []
        for r in rows:
            if r["source"] == source:
                words = WORD.findall(r["text"])
                u = (int(hashlib.md5(f"{mixing.SEED}:{r['doc_id']}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                symbols = len(re.findall(mixing.SYMBOL, r["text"]))
                own.append((-math.log(u) / max(0.1, 1 - symbols / max(len(words), 1)), r["doc_id"], words, r["text"]))
        while size and left >= size:
            out += [(d, t) for _, d, w, t in own if w]
            left -= size
        for _, d, w, t in sorted(own):
            if left <= 0:
                break
            if w:
                out.append((d, t if len(w) <= left else " ".join(w[:left])))
                left -= len(w)
    return out


def test_pipeline_equals_plain_version(shipped_spark):
    docs = shipped_spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = shipped_spark.read.parquet(f"{SF_DIR}/labels.parquet")
    items = {r[0]: r[1] for r in shipped_spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    model = quality.fit(docs, labels, remainder(F.col("doc_id"), 5) != 0)
    # Rules by hand on the statistics of each text.
    statistics = [f"_{n}" for n in quality.STATISTICS]
    rows = []
    for r in quality.with_statistics(docs).collect():
        x = [r[n] for n in statistics]
        total = model.intercept + sum(
            w for rule, w in model.rules if all((x[i] > v) if above else (x[i] <= v) for i, above, v in rule)
        )
        if 1 / (1 + math.exp(-total)) >= quality.THRESHOLD:
            rows.append({"doc_id": r.doc_id, "text": r.text or "", "source": r.source})
    root = brute_components({r["doc_id"]: shingle_set(r["text"]) for r in rows})
    rows = [r for r in rows if root[r["doc_id"]] == r["doc_id"]]
    rows = [r for r in rows if not shares_benchmark(r["text"], items)]
    expected = collections.Counter((d, len(plain_encode(t)) + 1) for d, t in plain_mix(rows))
    got = corpus_pipeline.run(shipped_spark, SF_DIR).toPandas()
    assert collections.Counter(zip(got.doc_id, got.n_tokens)) == expected
    got = got.sort_values("start")
    assert (got.start == np.cumsum(got.n_tokens) - got.n_tokens).all() and (np.diff(got.doc_id) >= 0).all()
    whole = got[~got.duplicated("doc_id", keep=False)].copy()
    texts = {r["doc_id"]: r["text"] for r in rows}
    whole = whole[[n == len(plain_encode(texts[d])) + 1 for d, n in zip(whole.doc_id, whole.n_tokens)]]
    for r in whole.itertuples():
        check_tokens(whole[whole.doc_id == r.doc_id].assign(start=0), texts)
