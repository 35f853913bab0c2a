from types import SimpleNamespace

import pytest

from vigil.plans import q_models as Q


class Stop(Exception):
    pass


@pytest.mark.parametrize("call", [lambda: Q.q_select_importance(None, ""), lambda: Q.q_importance(None, ""), lambda: Q._importance_top(None, Q.ENG, 5)])
def test_a_single_forest_has_the_library_size(monkeypatch, call):
    seen = []

    def pipeline(family, cols, **how):
        seen.append(how["n_estimators"])
        raise Stop

    monkeypatch.setattr(Q, "_eng", lambda spark, sf: SimpleNamespace(where=lambda c: None))
    monkeypatch.setattr(Q.M, "pipeline", pipeline)
    with pytest.raises(Stop):
        call()
    assert seen == [100]
