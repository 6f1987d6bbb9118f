import inspect

import pytest

from headway.ml import eta
from headway.plans import extended


class Stop(Exception):
    pass


@pytest.mark.parametrize("query", [extended.m6_model, extended.m8_fallback])
def test_queries_train_the_whole_model(spark, sf, monkeypatch, query):
    whole = inspect.signature(eta.train_model)

    def train_model(*args, **how):
        given = whole.bind(*args, **how)
        given.apply_defaults()
        assert all(given.arguments[k] == p.default for k, p in whole.parameters.items() if p.default is not p.empty)
        raise Stop

    monkeypatch.setattr(eta, "train_model", train_model)
    with pytest.raises(Stop):
        query(spark, sf)
