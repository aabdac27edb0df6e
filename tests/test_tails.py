import math

import pytest

from sparkassay.functions import tails


@pytest.mark.parametrize("x", [0.1, 1.0, 3.84, 10.0, 60.0])
def test_chi2_closed_forms(x):
    assert tails.chi2_sf(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-12)
    assert tails.chi2_sf(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-12)
    assert tails.chi2_sf(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-12)
    three = math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    assert tails.chi2_sf(x, 3) == pytest.approx(three, rel=1e-12)


def test_chi2_edges():
    assert tails.chi2_sf(0.0, 3) == 1.0
    assert tails.chi2_sf(5.0, 0) == 1.0
    assert 0 < tails.chi2_sf(1000.0, 1001) < 1


def test_signed_rank_small():
    assert tails.signed_rank_exact(0, 5) == pytest.approx(2 / 32)
    assert tails.signed_rank_exact(7, 5) == 1.0
    assert tails.signed_rank_exact(8, 10) == pytest.approx(0.048828125)
