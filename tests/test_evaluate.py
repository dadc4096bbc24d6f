import numpy as np
import pytest

from nutrilake.operators.evaluate import classification_metrics


def brute(t, p):
    labels = sorted(set(t) | set(p))
    t, p = np.array(t), np.array(p)
    prec, rec, f1 = [], [], []
    for k in labels:
        tp = np.sum((t == k) & (p == k))
        pk, tk = np.sum(p == k), np.sum(t == k)
        prec.append(tp / pk if pk else 0.0)
        rec.append(tp / tk if tk else 0.0)
        f1.append(2 * tp / (pk + tk) if (pk + tk) else 0.0)
    c, s = np.sum(t == p), len(t)
    pks = np.array([np.sum(p == k) for k in labels], dtype=float)
    tks = np.array([np.sum(t == k) for k in labels], dtype=float)
    den = np.sqrt((s * s - pks @ pks) * (s * s - tks @ tks))
    mcc = 0.0 if den == 0 else (c * s - pks @ tks) / den
    return dict(accuracy=c / s, precision_macro=np.mean(prec), recall_macro=np.mean(rec),
                f1_macro=np.mean(f1), mcc=mcc)


def test_metrics_match_brute_force(spark):
    rng = np.random.RandomState(0)
    t = list(rng.choice(["A", "B", "C", "D"], 200))
    p = [x if rng.rand() < 0.6 else str(rng.choice(["A", "B", "C"])) for x in t]
    df = spark.createDataFrame(list(zip(t, p)), "y string, yhat string")
    r = classification_metrics(df, "y", "yhat", ["A", "B", "C", "D"]).first()
    exp = brute(t, p)
    for k, v in exp.items():
        assert r[k] == pytest.approx(v, abs=1e-12)
    cm = np.array(r["confusion_matrix"])
    assert cm.shape == (4, 4) and cm.sum() == 200 and cm[:3, 3].sum() == 0   # "D" only kept, never guessed
    assert r["class_labels"] == ["A", "B", "C", "D"]


def test_absent_class_kept_and_zero_division(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "A")], "y string, yhat string")
    r = classification_metrics(df, "y", "yhat", ["A", "B", "C"]).first()
    assert r["accuracy"] == 1.0 and r["mcc"] == 0.0
    assert r["confusion_matrix"] == [[2, 0, 0], [0, 0, 0], [0, 0, 0]]
