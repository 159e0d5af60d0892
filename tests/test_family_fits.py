"""A query of one model family fits that one."""

from checks import queries


def test_a_family_is_fitted_alone(monkeypatch):
    class Baskets:
        fitted = {}

    asked = []
    monkeypatch.setattr(queries, "_parts", lambda b: ("train", "validation"))
    monkeypatch.setattr(queries.models, "fit_families", lambda t, v, s: asked.append(list(s)) or [(n, p, n) for n, p in s.items()])
    for _ in range(2):
        assert queries._family(Baskets, "network")[0] == "network"
    assert asked == [["network"]]
