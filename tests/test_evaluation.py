import random

import pytest
from helpers import as_dict, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from actionspark.operators import evaluation


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "action_label INT, predicted_label INT")


def brute_report(pairs):
    classes = sorted({x for p in pairs for x in p})
    out, total = {}, len(pairs)
    for c in classes:
        tp = sum(a == c and b == c for a, b in pairs)
        pred, sup = sum(b == c for _, b in pairs), sum(a == c for a, _ in pairs)
        p, r = (tp / pred if pred else 0.0), (tp / sup if sup else 0.0)
        out[str(c)] = (p, r, 2 * p * r / (p + r) if p + r else 0.0, sup)
    per = list(out.values())
    out["accuracy"] = (None, None, sum(a == b for a, b in pairs) / total, total)
    out["macro avg"] = tuple(sum(v[i] for v in per) / len(per) for i in range(3)) + (total,)
    out["weighted avg"] = tuple(sum(v[i] * v[3] for v in per) / total for i in range(3)) + (total,)
    return out


@pytest.mark.parametrize(
    "pairs",
    [
        [(0, 0), (0, 1), (1, 1), (2, 2), (2, 0), (2, 2)],
        [(0, 3), (0, 3), (1, 0)],  # a class never predicted, one never true, no hit at all
        [(1, 1)] * 5,
    ],
)
def test_classification_report(spark, pairs):
    got = {r["row"]: tuple(r)[1:] for r in evaluation.classification_report(scored(spark, pairs)).collect()}
    want = brute_report(pairs)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], nan_ok=True) if k != "accuracy" else got[k][2:] == pytest.approx(want[k][2:])


def test_report_and_accuracy_of_nothing(spark):
    empty = scored(spark, [])
    assert evaluation.classification_report(empty).count() == 0
    assert evaluation.accuracy(empty).first()["accuracy"] is None
    wrong = evaluation.accuracy(scored(spark, [(1, None), (1, 1)])).first()
    assert (wrong["n_rows"], wrong["n_correct"], wrong["accuracy"]) == (2, 1, 0.5)


def test_confusion_matrix_keeps_zero_cells(spark):
    df = scored(spark, [(0, 0), (0, 2), (0, 2), (7, 0)])
    got = rows(evaluation.confusion_matrix(df))
    assert got == [(a, p, {(0, 0): 1, (0, 2): 2}.get((a, p), 0)) for a in range(3) for p in range(3)]
    assert rows(evaluation.confusion_pivot(df)) == [(0, 1, 0, 2), (1, 0, 0, 0), (2, 0, 0, 0)]


def play(history):
    """Step by step what the promotion rule does to the aliases."""
    alias, acc, decisions = {}, {}, []
    for version, accuracy in history:
        acc[version] = accuracy
        alias["staging"] = version
        champion = alias.get("champion")
        if champion is None:
            alias["champion"] = version
            decisions.append("initial_champion")
        elif (accuracy or float("-inf")) >= (acc[champion] or float("-inf")):
            alias["prev_champion"], alias["champion"] = champion, version
            decisions.append("champion")
        else:
            alias["challenger"] = version
            decisions.append("challenger")
    return alias, decisions


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([None, 0.0, 0.3, 0.5, 0.5, 0.9]), min_size=1, max_size=8))
def test_promotion_replay_equals_playing_it(spark, accuracies):
    history = list(enumerate(accuracies, 1))
    df = spark.createDataFrame([("m", v, a) for v, a in history], "model STRING, version INT, accuracy DOUBLE")
    alias, decisions = play(history)
    replayed = evaluation.promotion_replay(df.repartition(3)).orderBy("version").collect()
    assert [r["decision"] for r in replayed] == decisions
    got = evaluation.promotion_aliases(df).first()
    for name in ("champion", "prev_champion", "challenger", "staging"):
        assert got[name] == alias.get(name)


def test_promotion_of_many_models_at_once(spark):
    rnd = random.Random(11)
    histories = {f"m{i}": [(v, rnd.choice([None, 0.0, rnd.random()])) for v in range(1, 20)] for i in range(40)}
    df = spark.createDataFrame(
        [(m, v, a) for m, h in histories.items() for v, a in h], "model STRING, version INT, accuracy DOUBLE"
    )
    got = as_dict(evaluation.promotion_aliases(df), "model")
    for m, h in histories.items():
        alias, _ = play(h)
        assert {k: v for k, v in got[m].items() if k != "model" and v is not None} == alias
