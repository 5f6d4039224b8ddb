import json
from collections import Counter

import numpy as np

from foliant.llm import knn


def test_every_vector_finds_k(spark):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((20, 48))
    # narrow clusters make the margin narrow; vectors that stand alone make small lists with far borders
    vecs = [centres[i % 20] + 0.01 * rng.standard_normal(48) for i in range(1200)] + [4 * rng.standard_normal(48) for _ in range(60)]
    schema = "id string, embedding_json string, dimensions int, vector_space_id string"
    c = spark.createDataFrame([(f"v{i:04d}", json.dumps(v.tolist()), 48, "s") for i, v in enumerate(vecs)], schema.replace("id", "chunk_id", 1))
    q = spark.createDataFrame([(f"q{i}", json.dumps(rng.standard_normal(48).tolist()), 48, "s") for i in range(40)], schema.replace("id", "query_id", 1))
    got = Counter((r.is_chunk, r.id) for r in knn.most_similar(c, q, list_rows=15, group_rows=300).collect())
    assert len(got) == 1300 and set(got.values()) == {5}


def test_a_vector_is_the_same_beside_any_rows(spark):
    rng = np.random.default_rng(3)
    vecs = rng.standard_normal((300, 96))
    schema = "chunk_id string, embedding_json string, dimensions int, vector_space_id string"
    rows = [(f"v{i}", json.dumps(v.tolist()), 96, "s") for i, v in enumerate(vecs)] + [("twin", json.dumps((3.5 * vecs[7]).tolist()), 96, "s")]
    every = {r.id: (bytes(r.same), bytes(r.vec)) for r in knn.unit_vectors(spark.createDataFrame(rows, schema).coalesce(1), "chunk_id", True).collect()}
    alone = {r.id: (bytes(r.same), bytes(r.vec)) for r in knn.unit_vectors(spark.createDataFrame(rows[-1:] + rows[7:8], schema).repartition(2), "chunk_id", True).collect()}
    assert all(every[i] == x for i, x in alone.items()) and every["twin"][0] == every["v7"][0] and len({x[0] for x in every.values()}) == 300


def test_cells_lead_to_the_near_lists():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((6000, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cells, lists, bounds = knn._two_levels(x, 900, 1)
    m = {"cells": cells, "centroids": lists, "bounds": bounds, "held": np.ones(len(lists), dtype=np.int64)}
    m["held"][::7] = 0
    whole, _ = knn.near_lists(m, x, 5)
    some, sims = knn.near_lists(m, x, 5, beam=16, whole=0)
    assert bounds[-1] == len(lists) and not (some % 7 == 0).any() and (np.diff(sims, axis=1) <= 0).all()
    assert np.mean([len(set(a) & set(b)) for a, b in zip(whole.tolist(), some.tolist())]) > 0.9 * 5


def test_a_small_index_still_finds(spark):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((30, 32))
    vecs = np.array([centres[i % 30] + 0.3 * rng.standard_normal(32) for i in range(2000)])
    vecs /= np.linalg.norm(vecs, axis=1, keepdims=True)
    c = spark.createDataFrame([(f"v{i:04d}", json.dumps(v.tolist()), 32, "s") for i, v in enumerate(vecs)], "chunk_id string, embedding_json string, dimensions int, vector_space_id string")
    s = vecs @ vecs.T
    np.fill_diagonal(s, -2)
    want = {f"v{i:04d}": {f"v{j:04d}" for j in np.argsort(-s[i])[:5]} for i in range(2000)}
    got = {}
    for r in knn.most_similar(c, list_rows=20, index_bytes=300 * 128).collect():  # 300 rows are sampled, at most 75 lists made
        got.setdefault(r.id, set()).add(r.near_id)
    assert sum(len(got[i] & want[i]) for i in want) > 0.9 * 5 * 2000
