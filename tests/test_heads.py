"""Heads trained together equal heads fitted one by one, and are proved optimal."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tagloom.operators import heads as H
from tagloom.operators import train as TR
from tagloom.session import release_stored


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    out = []
    for i in range(240):
        ids = [k for k in range(5) if rnd.random() < (0.3, 0.5, 0.1, 0.25, 0.02)[k]]
        text = " ".join(rnd.choices(words, k=12) + [f"t{k}" for k in ids if rnd.random() < 0.8] + [rnd.choice(["t0", "t1", "t3"])])
        out.append((i, text, ids, "train" if i % 5 < 3 else "val" if i % 5 == 3 else "test"))
    yield spark.createDataFrame(out, "row_id bigint, text string, ids array<int>, split string").repartition(3).cache()
    release_stored(spark)


def test_as_separate_fits_and_optimal(spark, rows):
    regs, n_labels = (0.01, 0.1), 6  # label 5 has no row at all
    model, heads, best, table, train = H.select_and_test_heads(rows, "text", "ids", n_labels, regs, num_features=256)
    certs = H.certificates(train, heads, 256)
    assert len(certs) == 12 and max(c[3] for c in certs) < 1e-4
    y = F.transform(F.sequence(F.lit(0), F.lit(n_labels - 2)), lambda k: F.array_contains("ids", k).cast("int"))
    data = rows.withColumn("y", y)
    feats = Pipeline(stages=TR.feature_stages("text", 256)).fit(rows.where("split = 'train'"))
    tr, va = (feats.transform(data.where(f"split = '{s}'")).select("features", "y").cache() for s in ("train", "val"))
    names = [str(i) for i in range(n_labels - 1)]
    for i, reg in enumerate(regs):
        fitted = TR._fit_heads(tr, [F.element_at("y", k + 1) for k in range(n_labels - 1)], names, reg, 200)
        alone = np.array([np.append(h.coefficients.toArray(), h.intercept) for h in fitted]).T
        assert np.abs(alone - heads.candidate(i)[:, :5]).max() < 5e-3
        want = TR.evaluate_heads(fitted, va, "y", names)
        got = H.score_heads(H.sparse_features(model, rows.where("split = 'val'"), "text", "ids"), heads.candidate(i)[:, :5])
        assert all(abs(want[c] - got[c]) < 1e-3 for c in TR.MULTI_COLS), (want, got)
    picked = {r["split"]: r for r in table.where("chosen").collect()}
    assert set(picked) == {"val", "test"} and picked["val"]["macro_f1"] == max(r["macro_f1"] for r in table.where("split = 'val'").collect())


def test_blocks_of_heads_and_small_slices_change_nothing(spark, rows, monkeypatch):
    model = Pipeline(stages=TR.feature_stages("text", 64)).fit(rows)
    feats = H.sparse_features(model, rows, "text", "ids").cache()
    whole = H.fit_heads(feats, 64, 5, (0.05,))
    monkeypatch.setattr(H, "WEIGHTS", 2 * 65)
    monkeypatch.setattr(H, "CELLS", 50)
    parts = H.fit_heads(feats, 64, 5, (0.05,))
    assert np.abs(whole.weights - parts.weights).max() < 1e-4


def test_passes_take_only_the_heads_that_still_move(spark, rows, monkeypatch):
    model = Pipeline(stages=TR.feature_stages("text", 64)).fit(rows)
    feats = H.sparse_features(model, rows, "text", "ids").cache()
    seen = []
    losses = H._losses
    monkeypatch.setattr(H, "_losses", lambda r, w, labels: seen.append(w.shape[1]) or losses(r, w, labels))
    heads = H.fit_heads(feats, 64, 6, (0.05, 5.0))
    assert seen[0] == 12 and sorted(seen, reverse=True) == seen and seen[-1] < 12
    monkeypatch.undo()
    assert max(c[3] for c in H.certificates(feats, heads, 64)) < 1e-4


def test_matrix_products_equal_sums_over_values():
    rng = np.random.default_rng(3)
    row = np.repeat(np.arange(5), [2, 0, 3, 1, 2])
    idx = np.array([1, 7, 0, 3, 7, 2, 3, 9])
    val, w = rng.normal(size=8), rng.normal(size=(11, 4))
    cols, x = H._matrix(row, idx, val, 5, 10)
    assert cols.tolist() == [0, 1, 2, 3, 7, 9] and x.shape == (5, 6)
    assert np.allclose(H._margins(w, row, idx, val, 5), H._sum_by(row, w[idx] * val[:, None], 5) + w[-1])
