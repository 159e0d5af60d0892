"""Queries that stand for a full-size model fit it with no smaller settings."""

from checks import queries


class Baskets:
    parts = ("train", "validation")


def test_the_perceptron_takes_all_its_steps(monkeypatch):
    asked = []
    monkeypatch.setattr(queries.models, "fit_perceptron", lambda train, **settings: asked.append((train, settings)))
    monkeypatch.setattr(queries, "_held_out_scores", lambda b, fit: fit(b.parts[0]))
    queries.perceptron(Baskets)
    assert asked == [("train", {})]


def test_families_are_compared_at_their_full_size(monkeypatch):
    asked = []
    monkeypatch.setattr(Baskets, "fitted", {}, raising=False)
    monkeypatch.setattr(Baskets, "spark", None, raising=False)
    monkeypatch.setattr(queries.models, "fit_families", lambda t, v, s: asked.append(s) or [(n, p, n) for n, p in s.items()])
    monkeypatch.setattr(queries.models, "model_comparison", lambda spark, entries, *parts: [name for name, _, _ in entries])
    assert queries.model_families(Baskets) == list(queries.models.QUICK)
    assert asked == [{name: {}} for name in queries.models.QUICK]
    queries._family(Baskets, "network")  # small settings are a fit of their own
    assert asked[6:] == [{"network": queries.models.QUICK["network"]}]
