"""Operators give equal results under different partitionings."""

import pytest

from clicklens import fixtures as fx
from clicklens.operators import metrics, profile, vocab
from conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("parts", [1, 7])
def test_profiles_and_metrics_ignore_partitioning(spark, parts):
    imp = fx.impressions(spark, SF_SMALL)
    alt = imp.repartition(parts)
    cols = fx.IMPRESSIONS.features
    assert _rows(vocab.vocabulary(imp, cols, fx.FIXTURE_THRESHOLDS)) == \
        _rows(vocab.vocabulary(alt, cols, fx.FIXTURE_THRESHOLDS))
    assert _rows(profile.top_values(imp, cols, 3)) == _rows(profile.top_values(alt, cols, 3))
    assert _rows(profile.cardinality_profile(imp, cols)) == _rows(profile.cardinality_profile(alt, cols))
    sc = fx.scored(spark, SF_SMALL)
    assert _rows(metrics.auroc(sc)) == _rows(metrics.auroc(sc.repartition(parts)))
    assert _rows(metrics.durbin_watson(sc, "id")) == _rows(metrics.durbin_watson(sc.repartition(parts), "id"))


def test_stash_ignores_partitioning(spark):
    imp = fx.impressions(spark, SF_SMALL)
    cols = fx.IMPRESSIONS.features
    a = vocab.stash_rare(imp, cols, fx.FIXTURE_THRESHOLDS, sentinels=fx.IMPRESSION_SENTINELS)
    b = vocab.stash_rare(imp.repartition(5, "cat3"), cols, fx.FIXTURE_THRESHOLDS,
                         sentinels=fx.IMPRESSION_SENTINELS)
    assert _rows(a) == _rows(b)
