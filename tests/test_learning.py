from pricegrid.catalog import learning


def test_learning_queries_train_with_the_defaults(monkeypatch):
    seen = []
    monkeypatch.setattr(learning.m, "train", lambda rows, **params: seen.append(params))
    learning._fit("rows")
    assert seen == [{}]
