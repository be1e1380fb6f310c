from pyspark.sql import functions as F

from tagloom.operators import metrics as M


def _brute_single(y, p):
    classes = sorted(set(y) | set(p))
    prec, rec, f1 = [], [], []
    for c in classes:
        tp = sum(1 for a, b in zip(y, p) if a == c and b == c)
        fp = sum(1 for a, b in zip(y, p) if a != c and b == c)
        fn = sum(1 for a, b in zip(y, p) if a == c and b != c)
        prec.append(tp / (tp + fp) if tp + fp else 0.0)
        rec.append(tp / (tp + fn) if tp + fn else 0.0)
        f1.append(2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0)
    acc = sum(1 for a, b in zip(y, p) if a == b) / len(y)
    return acc, sum(prec) / len(classes), sum(rec) / len(classes), sum(f1) / len(classes)


def test_single_metrics_match_brute_force(spark):
    y = ["a", "a", "b", "c", "c", "c", "b"]
    p = ["a", "b", "b", "c", "x", "c", "a"]  # 'x' only predicted: class union
    df = spark.createDataFrame(list(zip(y, p)), "y string, p string")
    m = M.classification_metrics(df, "y", "p").first()
    acc, pr, rc, f1 = _brute_single(y, p)
    assert abs(m.accuracy - acc) < 1e-12 and abs(m.precision - pr) < 1e-12
    assert abs(m.recall - rc) < 1e-12 and abs(m.f1 - f1) < 1e-12
    s = M.single_label_summary(M.confusion_matrix(df, "y", "p")).first()
    assert abs(s.micro_f1 - s.accuracy) < 1e-12  # single-label micro F1 = accuracy
    again = M.classification_metrics(df.repartition(5), "y", "p").first()
    assert again == m


def test_multilabel_metrics(spark):
    y = [[1, 0, 1], [0, 1, 0], [1, 1, 0]]
    prob = [[0.9, 0.2, 0.4], [0.1, 0.7, 0.5], [0.6, 0.8, 0.1]]
    df = spark.createDataFrame(list(zip(y, prob)), "y array<int>, p array<double>")
    m = M.multilabel_metrics(df, "y", "p", 0.5).first()
    # predictions [1,0,0] [0,1,1] [1,1,0]: tp=4 fp=1 fn=1
    assert abs(m.micro_precision - 0.8) < 1e-12 and abs(m.micro_recall - 0.8) < 1e-12
    assert abs(m.subset_acc - 1 / 3) < 1e-12
    # per label f1: l0 1.0, l1 1.0, l2 0 (tp 0 fp 1 fn 1)
    assert abs(m.macro_f1 - 2 / 3) < 1e-12


def test_best_epoch_ties(spark):
    h = spark.createDataFrame([(1, 3.0), (2, 3.0), (3, 2.0)], "epoch int, m double")
    assert M.best_epoch(h, "m").first().epoch == 1
    flags = {r.epoch: r.improved for r in M.improved_epochs(h, "m").collect()}
    assert flags == {1: True, 2: False, 3: False}


def test_fixed_class_report_ignores_unknown(spark):
    df = spark.createDataFrame([(["a"], ["a", "zzz"]), (["b"], [])], "g array<string>, p array<string>")
    summary, per_label = M.fixed_class_report(df, "g", "p", ["a", "b", "c"])
    s = summary.first()
    assert abs(s.subset_acc - 0.5) < 1e-12
    rows = per_label.collect()
    assert [r.label for r in rows] == ["a", "b", "c"] and rows[0].f1 == 1.0
