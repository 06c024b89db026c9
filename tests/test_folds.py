"""Model rows are stored before they are passed over many times, and folds are narrow."""

from tidemark.plans import scoring
from tidemark.workload import queries


def test_folds_hold_what_trees_read(spark, monkeypatch):
    held = []

    class Validator:
        def __init__(self, **_):
            pass

        def fit(self, df):
            held.extend(df.columns)
            raise InterruptedError

    monkeypatch.setattr(scoring, "CrossValidator", Validator)
    rows = spark.createDataFrame([(0, 1.0, 0, "k"), (1, 2.0, 1, "l")], "label int, x double, fold int, row_key string")
    try:
        scoring.search(rows, ["x"], draws=1)
    except InterruptedError:
        pass
    assert held == ["label", "fold", "__x"]


def test_joined_rows_are_stored_before_they_are_split(spark, folder, monkeypatch):
    seen = []
    real = queries.dataset.with_split

    def with_split(df, *args, **kwargs):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *args, **kwargs)

    monkeypatch.setattr(queries.dataset, "with_split", with_split)
    queries._model_rows(spark, folder)
    assert len(seen) == 1 and "Join" not in seen[0]
