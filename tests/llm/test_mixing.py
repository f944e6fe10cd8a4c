"""Raking against plain arithmetic."""

import random

import pytest

from citemill.llm import mixing


def raked(tokens, targets, rounds=400):
    """tokens: cell -> tokens; targets: by marginal, value -> weight."""
    share = {c: float(t) for c, t in tokens.items() if t}
    for _ in range(rounds):
        for k, own in enumerate(targets):
            total = sum(own.get(v, 0) for v in {c[k] for c in share})
            sums = {}
            for c, s in share.items():
                sums[c[k]] = sums.get(c[k], 0) + s
            share = {c: s * own.get(c[k], 0) / total / sums[c[k]] if sums[c[k]] else 0.0 for c, s in share.items()}
    return share


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    return [(i, "w " * rng.randint(0, 120), rng.choice(["a", "b", None]), rng.choice(["en", "de", "fr"]), rng.choice(["x", "y"]), "m", 5) for i in range(400)] + [(None, None, "a", "en", "x", "m", 5), (3, "", "zero", "en", "x", "m", 5)]


SCHEMA = "doc_id long, text string, source string, lang string, topic string, m_source string, Tokens int"


@pytest.mark.parametrize("cells", [mixing.MAX_CELLS, 1])
def test_targets(spark, rows, monkeypatch, cells):
    monkeypatch.setattr(mixing, "MAX_CELLS", cells)
    targets = {"source": {"a": 3, "b": 1, None: 1, "nowhere": 9}, "lang": {"en": 0.5, "de": 0.5}}
    out = mixing.mixed(spark.createDataFrame(rows, SCHEMA), targets=targets, keep=0.3)
    assert out.columns == ["doc_id", "source", "lang", "topic", "m_source", "tokens", "probability", "weight", "sampled"]
    tokens = {}
    for r in rows:
        cell = (r[2] or mixing.NULL, r[3], r[4])
        tokens[cell] = tokens.get(cell, 0) + len((r[1] or "").split())
    topics = {t: sum(n for c, n in tokens.items() if c[2] == t) ** mixing.TEMPER for t in "xy"}
    want = raked(tokens, [{"a": 3, "b": 1, mixing.NULL: 1}, targets["lang"], topics])
    total, got = sum(tokens.values()), out.collect()
    assert len(got) == len(rows)
    for r in got:
        cell = (r.source or mixing.NULL, r.lang, r.topic)
        ratio = 0.3 * total * want.get(cell, 0) / tokens[cell] if tokens[cell] else 0
        assert r.probability == pytest.approx(min(1, ratio), abs=1e-7) and r.weight == pytest.approx(max(1, ratio), abs=1e-7)
        assert not (r.sampled and r.probability == 0)
    # What is sampled, weighed, is near the targets.
    by = {v: sum(r.tokens * r.weight for r in got if r.sampled and r.source == v) for v in ("a", "b", None)}
    assert by["a"] == pytest.approx(0.6 * 0.3 * total, rel=0.25) and sum(by.values()) == pytest.approx(0.3 * total, rel=0.15)


def test_targets_that_cannot_be_met(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_ROUNDS", 12)
    docs = spark.createDataFrame([(1, "a b", "s", "en", "x"), (2, "a", "t", "de", "x")], "doc_id long, text string, source string, lang string, topic string")
    targets = {"source": {"s": 1, "t": 1}, "lang": {"en": 3, "de": 1}}
    with pytest.warns(RuntimeWarning, match="off its target"):
        assert mixing.mixed(docs, targets=targets).count() == 2
    with pytest.raises(ValueError, match="off its target"):
        mixing.mixed(docs, targets=targets, strict=True)
    with pytest.raises(ValueError, match="has a target"):
        mixing.mixed(docs, targets={"source": {"u": 1}})
    with pytest.raises(ValueError, match="no such marginals"):
        mixing.mixed(docs, targets={"color": {"u": 1}})
    assert mixing.mixed(docs.limit(0)).count() == 0
