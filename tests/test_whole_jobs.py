"""Queries do their whole job: rows that a narrower rule would leave out."""

import numpy as np

from qaforge.plans import registry


def test_every_vector_is_a_query_of_the_exact_search(spark, tmp_path):
    x = np.random.default_rng(4).normal(size=(150, 6)).astype(np.float32)
    rows = [(i * 3 + 1, v.tolist(), i % 4) for i, v in enumerate(x)]  # few ids are divisible by 20
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {}
    for r in registry.QUERIES["exact_vector_topk"](spark, str(tmp_path)).orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["vec_id"])
    ids = np.array([r[0] for r in rows])
    want = {}
    for i, v in enumerate(x.astype(np.float64)):
        d = np.round(((x.astype(np.float64) - v) ** 2).sum(1), 6)
        want[int(ids[i])] = ids[np.lexsort((ids, d))[:registry.VECTOR_K]].tolist()
    assert got == want
    assert "% 20" not in registry.ORACLE["exact_vector_topk"]
